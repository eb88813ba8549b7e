"""Benchmark decontamination with one Aho-Corasick automaton.

The automaton holds the windows (10 consecutive words; a shorter item is one
window) of the normalised benchmark items.  Each document is normalised the
same way, scanned once, and matches are mapped back to its words and to
offsets in the original text.

The benchmark is the fixed, stated query set; its size is checked before it is
broadcast.  Above ``block_chars`` it is split by item hash into blocks of that
size, and the documents pass one automaton after another.

Defined results: a null or empty text has no words and is clean; an item
without words has no window; items with one item_id count once; a null item_id
matches words and counts as one item, but is not among the listed ids; repeated
documents give one row each; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import batches_of, only, ship

WINDOW = 10
BLOCK_CHARS = 32_000_000
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[bytes]:
    """Normalised words: A-Z lower-cased, runs of digits, letters and non-ASCII characters."""
    return WORD.findall((text or "").encode().lower())


def _line(ws: list[bytes]) -> str:
    # one character per byte, each word between blanks
    return f" {b' '.join(ws).decode('latin-1')} "


def automaton(items: list[tuple[str | None, str]], window: int = WINDOW):
    """Automaton over the windows of (item_id, text); a value is (words, item numbers)."""
    import ahocorasick

    found: dict[str, tuple[int, set[int]]] = {}
    for number, (_, text) in enumerate(items):
        ws = words(text)
        size = min(window, len(ws))
        for i in range(len(ws) - size + 1 if size else 0):
            found.setdefault(_line(ws[i:i + size]), (size, set()))[1].add(number)
    a = ahocorasick.Automaton()
    for line, (size, numbers) in found.items():
        a.add_word(line, (size, tuple(sorted(numbers))))
    if found:
        a.make_automaton()
    return a if found else None


def scan(a, ws: list[bytes]) -> tuple[np.ndarray, set[int]]:
    """(hit by word, item numbers) of one document."""
    hit, numbers, starts = np.zeros(len(ws) + 1, np.int64), set(), None
    if a is not None and ws:
        for end, (size, which) in a.iter(_line(ws)):
            if starts is None:  # position of the blank after each word
                starts = np.cumsum([len(w) + 1 for w in ws])
            last = int(np.searchsorted(starts, end))
            hit[last - size + 1] += 1
            hit[last + 1] -= 1
            numbers.update(which)
    return np.cumsum(hit[:-1]) > 0, numbers


def spans(text: str, hit: np.ndarray) -> list[dict]:
    """Runs of hit words as code point offsets into the original text."""
    raw, out, last = text.encode(), [], -2
    if hit.any():
        for i, m in enumerate(WORD.finditer(raw.lower())):
            if hit[i]:
                s, e = (len(raw[:x].decode(errors="ignore")) for x in m.span())
                if last == i - 1:
                    out[-1]["end"] = e
                else:
                    out.append({"start": s, "end": e})
                last = i
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS,
                  with_spans: bool = False, columns: list[str] | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    ``with_spans`` adds ``spans array<struct<start:int,end:int>>`` in the original text, ``columns`` adds a struct
    ``row`` with these columns of the document.
    """
    spark = docs.sparkSession
    ship(spark)
    items = benchmark.selectExpr("cast(item_id as string) item_id", "cast(text as string) text").where("text is not null")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = int(-(-chars // block_chars)) or 1
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                     F.lit(None).cast("binary").alias("hit"), F.expr("cast(array() as array<string>)").alias("ids"),
                     *([F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")] if columns else []))
    state = "doc_id long, text string, hit binary, ids array<string>"
    out = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    if with_spans:
        out += ", spans array<struct<start:int,end:int>>"
    if columns:
        row = f", row {df.schema['row'].dataType.simpleString()}"
        state, out = state + row, out + row
    for b in range(blocks):
        part = [tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).toLocalIterator()]
        df = df.mapInArrow(_scanner(spark.sparkContext.broadcast(part), window, b == blocks - 1, with_spans),
                           out if b == blocks - 1 else state)
    return df


def _scanner(shared, window: int, last: bool, with_spans: bool):
    key = uuid.uuid4().hex

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from vigil.llm import decontaminate as m

        a, names = only(key, lambda: (m.automaton(shared.value, window), [i for i, _ in shared.value]))
        for batch in it:
            for part in batches_of(batch, "text"):
                rows = []
                for doc, text, hit0, ids0 in zip(*(c.to_pylist() for c in part.columns[:4])):
                    ws = m.words(text)
                    hit, numbers = m.scan(a, ws)
                    if hit0 is not None:
                        hit |= np.unpackbits(np.frombuffer(hit0, np.uint8), count=len(ws)).astype(bool)
                    ids = {*(ids0 or ()), *(names[i] for i in numbers)}
                    if not last:
                        rows.append((doc, text, np.packbits(hit).tobytes(), list(ids)))
                        continue
                    listed = sorted(x for x in ids if x is not None)
                    n = int(hit.sum())
                    rows.append((doc, len(ws), n, len(ids), hashlib.sha256(",".join(listed).encode()).hexdigest(), n > 0)
                                + ((m.spans(text or "", hit),) if with_spans else ()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)] + part.columns[4:],
                                                 names=columns + ["row"] * len(part.columns[4:]))

    s, l, b = pa.string(), pa.int64(), pa.bool_()
    if last:
        columns, types = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"], [l, l, l, l, s, b]
        if with_spans:
            columns.append("spans")
            types.append(pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
    else:
        columns, types = ["doc_id", "text", "hit", "ids"], [l, s, pa.binary(), pa.list_(s)]
    return run
