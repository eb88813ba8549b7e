"""Quality rules: base counts, then tokeniser fertility against bands per language.

A public vocabulary with byte fallback encodes each text.  Words with a digit
say nothing about the language, so they have a measure of their own beside
those of the other words.  Measures:

* ``chars_per_token``   code points of words for each token,
* ``byte_share``        share of tokens that are single fallback bytes,
* ``symbol_share``      share of tokens without a letter, digit or sentence mark,
* ``entropy``           bits of the text's own token distribution,
* ``digit_share``       share of the text's tokens in words with a digit; pure
  numbers (digits, signs and separators) are no tokens here.

``bands`` takes the median and the spread (interquartile range / 1.349) of each
measure over all documents that pass the base rules, by language and by the
power of two of the token count, as entropy grows with length.  A document is
rejected when its deviations of characters per token and entropy sum below
``-low``, when characters per token lie more than ``high`` spreads above, or
when its byte, symbol or digit share is over the upper quartile plus a margin (of symbols, a
quartile of ``symbol_most`` at most counts, so that junk that fills a small
group can't excuse itself).  Values are rounded to 1/100 first, so a band's
state is a small histogram.

Defined results: a null or empty text has no words, fails the base rules and
has zero measures; a text of words with digits alone is judged by its digit
share; a null language is a group of its own; groups of under
``least`` documents are joined with the nearest lengths of their language until
they have so many, entropy then being raised by the bits that a text is shorter
than their mean; a language of under ``least`` documents has no bands and is
judged by the base rules alone; repeated rows are judged each; long texts are whole; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vigil.llm.common import SPACE, batches_of, hash_words, mix, phrase_hashes, ship, text_buffers
from vigil.llm.vocab import PieceBpe, opened, vocabulary

REPEAT_WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
# a word is tried once, at its start, and without going back
_DIGITS = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+")
_NUMBER = re.compile(r"[\W_0-9]+")
_WORDY = re.compile(r"[^\x20\x09-\x0D]")
_SENTENCE = set(".,;:!?'\"()-–—…«»“”‘’¿¡")

MEASURES = ("doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
            "n_repeat_words long, n_tokens long, chars_per_token double, byte_share double, symbol_share double, "
            "entropy double, digit_share double")


def repeated_words(h: np.ndarray, first: np.ndarray, k: int = REPEAT_WINDOW) -> np.ndarray:
    """Words of each text that lie in a k-word window found twice or more in that text."""
    n_docs, g = len(first) - 1, phrase_hashes(h, k)
    doc = np.repeat(np.arange(n_docs), np.diff(first))
    if not len(g):
        return np.zeros(n_docs, np.int64)
    same = doc[:len(g)] == doc[k - 1:]  # windows inside one text
    at = np.flatnonzero(same)
    key = mix(g[at] + mix(doc[at].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    s = key[order]
    twin = np.zeros(len(s), bool)
    twin[1:] = s[1:] == s[:-1]
    twin[:-1] |= twin[1:]
    edge = np.zeros(len(h) + 1, np.int64)
    where = at[order[twin]]
    np.add.at(edge, where, 1)
    np.add.at(edge, where + k, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return np.bincount(doc[covered], minlength=n_docs)


def dup_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if _WORDY.search(x)]
    return len(lines) - len(set(lines))


def _plain(bpe: PieceBpe) -> np.ndarray:
    """By id: the piece has neither a letter or digit nor only sentence marks."""
    flags = np.zeros(bpe.sp.get_piece_size(), bool)
    for i in range(len(flags)):
        s = bpe.sp.id_to_piece(i).replace("▁", "")
        flags[i] = bool(s) and not bpe.is_byte[i] and not any(c.isalnum() or c in _SENTENCE for c in s)
    return flags


def measure(docs: DataFrame, tokenizer: str = "piece_bpe_32k.model") -> DataFrame:
    """Base counts and fertility measures of every whole text, one row per document."""
    ship(docs.sparkSession)
    path = vocabulary(tokenizer)
    names = [c.split()[0] for c in MEASURES.split(", ")]
    types = [{"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[c.split()[1]] for c in MEASURES.split(", ")]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = opened(PieceBpe, path)
        symbol = _plain(bpe)
        for batch in it:
            for part in batches_of(batch, "text"):
                data, offsets = text_buffers(part.column(2))
                h, first, starts, ends = hash_words(data, offsets)
                lead = np.concatenate([[0], np.cumsum(~SPACE[data] & ((data & 0xC0) != 0x80))])
                marks = np.concatenate([[0], np.cumsum(SYMBOLS[data])])
                texts = [t or "" for t in part.column(2).to_pylist()]
                plain = [_DIGITS.sub(" ", t) for t in texts]
                coded = [" ".join(w for w in _DIGITS.findall(t) if not _NUMBER.fullmatch(w)) for t in texts]
                rows = []
                for t, b, c in zip(plain, bpe.encode(plain), bpe.encode(coded)):
                    ids = np.frombuffer(b, "<u4")
                    n, m = len(ids), len(c) // 4
                    if not n:
                        rows.append((0, 0.0, 0.0, 0.0, 0.0, float(m > 0)))
                        continue
                    counts = np.bincount(np.unique(ids, return_inverse=True)[1])
                    rows.append((n, len("".join(t.split())) / n, float(bpe.is_byte[ids].mean()),
                                 float(symbol[ids].mean()), float(np.log2(n) - (counts * np.log2(counts)).sum() / n),
                                 m / (n + m)))
                fert = list(zip(*rows))
                cols = [part.column(0), part.column(1), np.diff(first), lead[offsets[1:]] - lead[offsets[:-1]],
                        marks[offsets[1:]] - marks[offsets[:-1]], [dup_lines(t) for t in texts],
                        repeated_words(h, first), *fert]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t)
                                                  for c, t in zip(cols, types)], names=names)

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(lang as string) lang",
                           "cast(text as string) text").mapInArrow(run, MEASURES)


def _failed():
    return ((F.col("n_words") < MIN_WORDS)
            | (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words")))


BANDED = ("chars_per_token", "entropy", "byte_share", "symbol_share", "digit_share")


def _bands(m: DataFrame, least: int) -> DataFrame:
    """Quartiles of each measure and mean length by (lang_l, size_l), over the nearest lengths of the language that
    hold ``least`` documents; ``reach`` is how far they lie."""
    fit = m.where("not base_failed and n_tokens > 0")
    kinds = F.array(*[F.struct(F.lit(c).alias("kind"), F.round(c, 2).alias("value")) for c in BANDED])
    hist = (fit.select("lang", "size_class", F.explode(kinds).alias("x"))
            .groupBy("lang", "size_class", "x.kind", "x.value").agg(F.count("*").alias("n")))
    counts = fit.groupBy("lang", "size_class").agg(F.count("*").alias("docs"), F.sum("length").alias("lengths"))
    groups = m.groupBy("lang", "size_class").agg(F.lit(1).alias("one")).selectExpr("lang lang_l", "size_class size_l")
    same = F.col("lang").eqNullSafe(F.col("lang_l"))
    group = Window.partitionBy("lang_l", "size_l")
    near = (groups.join(counts, same).withColumn("far", F.abs(F.col("size_class") - F.col("size_l")))
            .withColumn("sum", F.sum("docs").over(group.orderBy("far").rangeBetween(Window.unboundedPreceding, 0)))
            .withColumn("reach", F.min(F.when(F.col("sum") >= least, F.col("far"))).over(group)).where("far <= reach")
            .withColumn("mean_length", F.sum("lengths").over(group) / F.sum("docs").over(group))
            .select("lang_l", "size_l", "reach", "mean_length", F.col("size_class").alias("size")))
    q = F.percentile("value", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n"))
    by_kind = (near.join(hist, same & (F.col("size") == F.col("size_class")))
               .groupBy("lang_l", "size_l", "reach", "mean_length", "kind").agg(q.alias("q")))
    return by_kind.groupBy("lang_l", "size_l", "reach", "mean_length").agg(
        *[F.max(F.when(F.col("kind") == c, F.col("q"))).alias(f"{c}_l") for c in BANDED])


def judge(measured: DataFrame, low: float = 4.0, high: float = 12.0, byte_margin: float = 0.10,
          symbol_margin: float = 0.06, symbol_most: float = 0.05, least: int = 30,
          digit_margin: float = 0.5) -> DataFrame:
    """Adds base_failed and kept; ``measured`` is read more than once, so give a stored table."""
    m = (measured.withColumn("base_failed", _failed())
         .withColumn("length", F.log2(F.col("n_tokens") + 1)).withColumn("size_class", F.floor("length").cast("int")))
    j = m.join(_bands(m, least), F.col("lang").eqNullSafe(F.col("lang_l")) & (F.col("size_class") == F.col("size_l")), "left")
    shorter = F.when(F.col("reach") > 0, F.greatest(F.col("mean_length") - F.col("length"), F.lit(0.0))).otherwise(F.lit(0.0))

    def at(c: str, i: int):
        return F.col(f"{c}_l")[i]

    def z(c: str, floor: float, more=F.lit(0.0)):
        return (F.col(c) + more - at(c, 1)) / F.greatest((at(c, 2) - at(c, 0)) / 1.349, F.lit(floor))

    cpt, ent = z("chars_per_token", 0.03), z("entropy", 0.06, shorter)
    bad = ((cpt + ent < -low) | (cpt > high)
           | (F.col("byte_share") > at("byte_share", 2) + byte_margin)
           | (F.col("symbol_share") > F.least(at("symbol_share", 2), F.lit(symbol_most)) + symbol_margin))
    coded = F.col("digit_share") > at("digit_share", 2) + digit_margin
    verdict = ~F.coalesce(coded | (bad & (F.col("n_tokens") > 0)), F.lit(False))
    return j.withColumn("kept", ~F.col("base_failed") & verdict).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_tokens", "chars_per_token", "byte_share", "symbol_share", "entropy")
