"""Token counts with overlap resynchronisation of huge documents.

A document of up to ``chunk`` code points is encoded in one task: word by word,
each with the white space before it, because a visible character followed by
white space is always a boundary (below); counts of words are kept.  A longer
one is cut into chunks that overlap, which are dealt to all tasks and encoded with
offsets.  Each chunk reports the places in its two overlaps at which a token of
its own encoding ends and the text proves a boundary; neighbours are spliced
at the first place that both report.  Tokens before that place are counted in
the left chunk, those behind it in the right one.

Why such a place is safe: the tokenizer first splits a text by a pattern that
reads from left to right, and no alternative of the pattern matches across

* a visible character followed by a white space character,
* an ASCII letter followed by a digit or a digit followed by a letter,
* an ASCII letter or digit beside one of the marks in ``MARKS`` (which occur
  neither in contractions nor in special strings).

So the encoding starts anew at such a place, whatever stood before it, and the
tokens behind it are those of the whole text.

When neighbours have no place in common (a very long run of one kind), the
document is cut again with chunks and overlaps ``WIDEN`` times as large.  A
chunk that reaches the end of its document reports that end, so this stops
when one chunk holds the document; each round reads only what is left.

Defined results: a null text is empty and has no tokens; repeated rows are
counted each; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import batches_of, ship
from vigil.llm.vocab import opened, vocabulary
from vigil.session import materialize

CHUNK = 1 << 16
OVERLAP = 1 << 9
WIDEN = 8
MARKS = r",;:!?()\[\]{}\"#$%&*+=/@^~"
#: Between two characters; white space and the classes are ASCII, where every version of Unicode agrees.
_PROVEN = re.compile(rf"(?<=[!-~À-ÿĀ-ſ])(?=[ \t\n\r])|(?<=[A-Za-z])(?=[0-9{MARKS}])|(?<=[0-9])(?=[A-Za-z{MARKS}])|(?<=[{MARKS}])(?=[A-Za-z0-9])")


#: A word with the white space before it; texts with other white space or controls are encoded whole.
_UNIT = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
_ODD = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")
KEPT = 600_000


class ByteBpe:
    """Counts of ``byte_bpe_50k.json``, special strings as the library handles them by default."""

    def __init__(self, path: str):
        import os

        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        self.placed = Tokenizer.from_file(path)  # with untrimmed offsets: a token ends where the next begins
        self.placed.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=False, use_regex=True)

        self.known, self.older = {}, {}  # tokens of words; the older half goes when the newer one is full

    def whole_counts(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]

    def counts(self, texts: list[str]) -> list[int]:
        odd = [i for i, t in enumerate(texts) if _ODD.search(t)]
        out = [0] * len(texts)
        for i, n in zip(odd, self.whole_counts([texts[i] for i in odd])):
            out[i] = n
        plain = sorted(set(range(len(texts))) - set(odd))
        units = [_UNIT.findall(texts[i]) for i in plain]
        known = self.known
        new = {u for us in units for u in us if u not in known}
        if len(known) + len(new) > KEPT:
            self.older, self.known = known, (known := {u: known[u] for us in units for u in us if u in known})
        kept = new & self.older.keys()
        known.update((u, self.older[u]) for u in kept)
        new = list(new - kept)
        for lo in range(0, len(new), 4096):
            known.update(zip(new[lo:lo + 4096], self.whole_counts(new[lo:lo + 4096])))
        for i, us in zip(plain, units):
            out[i] = sum(map(known.__getitem__, us))
        return out

    def ends(self, text: str) -> np.ndarray:
        return np.array([b for _, b in self.placed.encode(text, add_special_tokens=False).offsets], np.int64)


def places(text: str, ends: np.ndarray, lo: int, hi: int, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """(places, tokens before each) in [lo, hi] at which a token ends and the text proves a boundary."""
    # the look-arounds need a character on both sides; what lies behind the chunk is not known
    at = np.array([m.start() for m in _PROVEN.finditer(text, lo, min(hi + 1, len(text))) if lo < m.start() <= hi], np.int64)
    if last and hi >= len(text):
        at = np.append(at, len(text))
    before = np.searchsorted(ends, at, side="right")
    good = (before > 0) & (ends[np.maximum(before - 1, 0)] == at) if len(ends) else np.zeros(len(at), bool)
    return at[good], before[good]


_PIECES = "key long, part long, start long, last boolean, text string"
_REPORT = ("key long, part long, total long, last boolean, head_at array<long>, head_n array<long>, "
           "tail_at array<long>, tail_n array<long>")


def _cut(docs: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Overlapping pieces of the texts of ``docs`` (key, text), dealt to all tasks."""

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _PIECES.split(", ")]
        for batch in it:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for part, start in enumerate(range(0, len(text), chunk)):
                    end = min(len(text), start + chunk + overlap)
                    last = end == len(text)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key]), pa.array([part], pa.int64()), pa.array([start], pa.int64()), pa.array([last]),
                         pa.array([text[start:end]], pa.string())], names=names)
                    if last:
                        break

    return docs.select("key", "text").mapInArrow(cut, _PIECES).repartition("key", "part")


def _reports(pieces: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    def report(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = opened(ByteBpe, path)
        names = [c.split()[0] for c in _REPORT.split(", ")]
        for batch in it:
            for key, part, start, last, text in zip(*(c.to_pylist() for c in batch.columns)):
                ends = bpe.ends(text)
                # where this chunk takes over from the one before, and where the next one takes over
                head = places(text, ends, 0, min(overlap, len(text)), last) if part else (np.zeros(0, int),) * 2
                tail = (np.zeros(0, int),) * 2 if last else places(text, ends, chunk, len(text), False)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key]), pa.array([part]), pa.array([len(ends)]), pa.array([last])]
                    + [pa.array([x.tolist()], pa.list_(pa.int64())) for x in (head[0] + start, head[1], tail[0] + start, tail[1])],
                    names=names)

    return pieces.mapInArrow(report, _REPORT)


def _spliced(reports: DataFrame) -> DataFrame:
    """key, n_tokens (null where neighbours have no place in common)."""
    w = Window.partitionBy("key").orderBy("part")
    r = (reports.withColumn("next_at", F.lead("head_at").over(w)).withColumn("next_n", F.lead("head_n").over(w)))
    common = F.array_min(F.array_intersect("tail_at", "next_at"))
    r = r.withColumn("seam", F.when(~F.col("last"), common))
    # tokens of this chunk up to the seam, less those of the next chunk before it
    left = F.element_at("tail_n", F.array_position("tail_at", F.col("seam")).cast("int"))
    right = F.element_at("next_n", F.array_position("next_at", F.col("seam")).cast("int"))
    own = F.when(F.col("last"), F.col("total")).otherwise(F.when(F.col("seam").isNotNull(), left - right))
    return (r.select("key", own.alias("own")).groupBy("key")
            .agg(F.when(F.count("own") == F.count("*"), F.sum("own")).alias("n_tokens")))


def token_counts(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 1024, chunk: int = CHUNK,
                 overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of all documents."""
    ship(docs.sparkSession)
    path = vocabulary(tokenizer)
    d = docs.selectExpr("cast(doc_id as long) doc_id", "coalesce(cast(text as string), '') text")
    huge = F.length("text") > chunk

    def whole(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = opened(ByteBpe, path)
        for batch in it:
            for part in batches_of(batch, "text", 1 << 19):
                n = bpe.counts(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n, pa.int64())],
                                                 names=["doc_id", "n_bytes", "n_tokens"])

    shape = "doc_id long, n_bytes long, n_tokens long"
    sized = d.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    counts = [sized.where(~huge).mapInArrow(whole, shape)]
    # a key of its own for each huge row; written, so that it is the same in all rounds
    left = materialize(sized.where(huge).withColumn("key", F.monotonically_increasing_id()), "huge")
    rows = left.select("key", "doc_id", "n_bytes")
    while not left.isEmpty():
        done = materialize(_spliced(_reports(_cut(left, chunk, overlap), path, chunk, overlap)), "spliced")
        counts.append(rows.join(done.where("n_tokens is not null"), "key").select("doc_id", "n_bytes", "n_tokens"))
        failed = done.where("n_tokens is null").select("key")
        chunk, overlap = chunk * WIDEN, overlap * WIDEN
        left = left if failed.isEmpty() else left.join(failed, "key")
        if failed.isEmpty():
            break
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
