"""Source divergence audit by ranking of count cells.

Each language keeps the terms that stand in at least ``least`` of its
documents.  A source gives each kept term p = 1 + floor(SCALE * (count + 1) /
(N + V)), with N the sum of its counts and V the number of kept terms; so does
the whole language.  Two distributions differ in a term by
f = floor((p - q) * (p - q) / q).

f depends on a term only through two counts.  So terms are never scored one by
one; they are grouped into cells of equal counts, and f is evaluated once for
each cell:

* ``pair`` compares two sources: cells (count here, count there).  Terms that
  both hold are counted into cells by the tasks that read them; the cells with
  a zero follow from the histogram of each source alone, so no term is listed
  for sources that do not hold it.
* ``term`` ranks the terms that a source uses more than its language: cells
  (count in the source, count in the language).  Cells of equal f are merged,
  values are ranked by their cumulative multiplicity, and only the cells that
  reach the first ``top`` ranks are expanded into terms, in UTF-8 order.

What moves: packed counts of each task's terms, keyed by ranges of the terms'
hashes, then cells.  Sums of f are made of a high and a low half and products
stay under 2**60, so all figures are exact.  Terms are told apart by 64-bit
hashes of language and bytes, sources by 64-bit hashes of their names.

Defined results: null text, language or source is the empty string; a source
without kept terms is compared with all counts 0; a language without kept
terms has pairs of value 0 and no terms; repeated rows are documents each;
an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import (LOWER, batches_of, byte_set, gathered, hash_words, lang_keys, mix, owners, shuffle_partitions,
                              ship, text_buffers, text_bytes)
from vigil.session import materialize

SCALE = 1_000_000_000
BREAK = ~byte_set((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
HELD = 1_500_000     # words that a task holds before it sends their counts
RANGE = 4 << 20      # bytes of text for each range of hashes
PAIRS = 1_000_000    # pairs of counts that a task groups into cells at once

_PACKED = ("part long, langs array<string>, lang binary, key binary, entries binary, length binary, words binary, "
           "source binary, n binary, docs binary")
_KEPT = "lang string, term string, n long, held array<struct<source:long,n:long>>"


class Words:
    """Words of a task's texts, until their counts are sent."""

    def __init__(self):
        self.parts, self.held, self.rows = [], 0, 0

    def add(self, langs: list[str], sources: np.ndarray, column) -> None:
        data, offsets = text_buffers(column)
        h, first, starts, ends = hash_words(data, offsets, BREAK, fold=True)
        row = np.repeat(np.arange(len(langs)), np.diff(first))
        key = mix(h ^ lang_keys(langs)[row]) if len(h) else h
        self.parts.append((langs, sources, key, row + self.rows, LOWER[data], starts, ends))
        self.held, self.rows = self.held + len(h), self.rows + len(langs)

    def packed(self, parts: int) -> dict[str, list]:
        """Counts by word and source, a filling for each range of hashes; the words are forgotten."""
        langs = [x for p in self.parts for x in p[0]]
        names, source = np.unique(np.concatenate([p[1] for p in self.parts]), return_inverse=True)
        known, lang = np.unique(np.array(langs, object), return_inverse=True)
        key, row = (np.concatenate([p[i] for p in self.parts]) for i in (2, 3))
        text = np.concatenate([p[4] for p in self.parts])
        base = np.cumsum([0] + [len(p[4]) for p in self.parts])
        starts, ends = (np.concatenate([p[i] + z for p, z in zip(self.parts, base)]) for i in (5, 6))
        self.__init__()
        # by word, then source, then row: a word and source is an entry, and each row in it a document
        of = source[row].astype(np.uint16 if len(names) < 1 << 16 else np.uint32)
        order = np.argsort(of, kind="stable")
        order = order[np.argsort(key[order], kind="stable")]
        key, of, row = key[order], of[order], row[order]
        changed = lambda x: np.concatenate([[True], x[1:] != x[:-1]])
        word = changed(key)
        entry = word | changed(of)
        w, at = np.flatnonzero(word), np.flatnonzero(entry)
        n = np.diff(np.append(at, len(key)))
        docs = np.add.reduceat((entry | changed(row)).astype(np.int64), at)
        first = np.searchsorted(at, w)
        entries = np.diff(np.append(first, len(at)))
        spelled, cuts = gathered(text, starts[order[w]], ends[order[w]])
        owner = owners(key[w], parts)
        lo = np.flatnonzero(changed(owner))
        words, every = np.append(lo, len(w)), np.append(first[lo], len(at))
        cut = lambda x, at: [x[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        return {"part": owner[lo].astype(np.int64), "langs": [known.tolist()] * len(lo),
                "lang": cut(lang[row[w]].astype(np.uint32), words), "key": cut(key[w], words),
                "entries": cut(entries.astype(np.uint32), words), "length": cut(np.diff(cuts).astype(np.uint32), words),
                "words": cut(spelled, cuts[words]), "source": cut(names[of[at]], every), "n": cut(n.astype(np.int64), every),
                "docs": cut(docs, every)}


def merged(table: pa.Table, least: int) -> pa.Table:
    """Kept terms of one range of hashes, from the fillings of all tasks."""
    def read(c, t):
        return [np.frombuffer(x, t) for x in table[c].to_pylist()]

    known = table["langs"].to_pylist()
    langs, place = np.unique(np.array([x for row in known for x in row], object), return_inverse=True)
    base = np.cumsum([0] + [len(x) for x in known])
    lang = np.concatenate([place[z + codes] for z, codes in zip(base, read("lang", np.uint32))])
    key = np.concatenate(read("key", np.uint64))
    word = np.repeat(np.arange(len(key)), np.concatenate(read("entries", np.uint32)))
    ends = np.cumsum(np.concatenate(read("length", np.uint32)).astype(np.int64))
    source, n, docs = (np.concatenate(read(c, np.int64)) for c in ("source", "n", "docs"))
    order = np.argsort(source, kind="stable")
    order = order[np.argsort(key[word[order]], kind="stable")]
    source, word, n, docs = source[order], word[order], n[order], docs[order]
    term = np.concatenate([[True], key[word[1:]] != key[word[:-1]]])
    at = np.flatnonzero(term | np.concatenate([[True], source[1:] != source[:-1]]))
    t = np.flatnonzero(term)
    kept = np.add.reduceat(docs, t) >= least
    size = np.diff(np.append(np.searchsorted(at, t), len(at)))
    mine = np.repeat(kept, size)
    pairs = pa.StructArray.from_arrays([pa.array(source[at][mine]), pa.array(np.add.reduceat(n, at)[mine])], names=["source", "n"])
    held = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size[kept])]), pa.int32()), pairs)
    word = word[t][kept]
    spelled, cuts = gathered(np.concatenate(read("words", np.uint8)), np.where(word > 0, ends[word - 1], 0), ends[word])
    terms = pa.LargeStringArray.from_buffers(len(word), pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(spelled))
    return pa.table({"lang": pa.array(langs[lang[word]], pa.string()), "term": terms.cast(pa.string()),
                     "n": pa.array(np.add.reduceat(n, t)[kept]), "held": held})


def kept_terms(docs: DataFrame, least: int = 3) -> DataFrame:
    """lang, term, n (in the language), held: array of (hash of the source, n), in order of the hashes."""
    spark = docs.sparkSession
    ship(spark)
    parts = max(shuffle_partitions(spark), math.ceil(text_bytes(docs) / RANGE))

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, {"long": pa.int64(), "binary": pa.binary()}.get(t, pa.list_(pa.string())))
                            for n, t in (c.split() for c in _PACKED.split(", "))])
        words = Words()
        for batch in it:
            for some in batches_of(batch, "text"):
                words.add(some.column(0).to_pylist(), np.asarray(some.column(1)), some.column(2))
                if words.held > HELD:
                    yield pa.RecordBatch.from_pydict(words.packed(parts), schema)
        if words.held:
            yield pa.RecordBatch.from_pydict(words.packed(parts), schema)

    def merge(table: pa.Table) -> pa.Table:
        from vigil.llm.divergence import merged

        return merged(table, least)

    return (docs.selectExpr("coalesce(cast(lang as string), '') lang", "xxhash64(coalesce(cast(source as string), '')) source",
                            "cast(text as string) text").mapInArrow(count, _PACKED)
            .repartition(parts, "part").groupBy("part").applyInArrow(merge, _KEPT))


def shared_cells(kept: DataFrame) -> DataFrame:
    """lang, source, other, a, b, m: number of terms with count a in ``source`` and b in ``other`` (source < other,
    both counts over 0), as partial numbers of each task."""
    ship(kept.sparkSession)
    names = ["lang", "source", "other", "a", "b"]

    def cells(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows = [], 0

        def grouped() -> Iterator[pa.RecordBatch]:
            t = pa.concat_tables(waiting).group_by(names).aggregate([([], "count_all")])
            yield from t.rename_columns([*names, "m"]).combine_chunks().to_batches()

        for batch in it:
            held = batch.column(1)
            size = np.diff(np.asarray(held.offsets))
            source, n = held.flatten().flatten()
            lang = batch.column(0).take(pa.array(np.repeat(np.arange(len(size)), size)))
            left = np.repeat(np.cumsum(size), size) - np.arange(len(source))  # entries of the term from here on
            i, step = np.arange(len(source)), 1
            while len(i := i[left[i] > step]):
                at, to = pa.array(i), pa.array(i + step)
                waiting.append(pa.table([lang.take(at), source.take(at), source.take(to), n.take(at), n.take(to)], names))
                rows, step = rows + len(i), step + 1
                if rows > PAIRS:
                    yield from grouped()
                    waiting, rows = [], 0
        if waiting:
            yield from grouped()

    return kept.select("lang", "held").mapInArrow(cells, "lang string, source long, other long, a long, b long, m long")


def _p(count: str, n: str, v: str) -> str:
    long = f"{SCALE}L * ({count} + 1) div ({n} + {v})"
    wide = f"(cast({SCALE} as decimal(10, 0)) * cast({count} + 1 as decimal(20, 0))) div cast({n} + {v} as decimal(20, 0))"
    return f"(1 + if({count} < {2**63 // SCALE - 1}L, {long}, {wide}))"


def _f(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) div {q})"


def _weighed(x: str) -> list[str]:
    """A sum of m * x in two halves, as m * x can pass 64 bits."""
    return [f"sum(m * shiftright({x}, 30)) high", f"sum(m * ({x} & {2**30 - 1}L)) low"]


def _pairs(kept: DataFrame, groups: DataFrame, entries: DataFrame) -> DataFrame:
    """lang, source, item, value: sum of f over all kept terms, from cells."""
    own = groups.selectExpr("lang", "source", "n", "v", f"if(v > 0, {_p('0', 'n', 'v')}, null) zero")
    other = own.selectExpr("lang", "source other", "n other_n", "zero other_zero")
    nothing = _f("zero", "other_zero")
    # all terms as if neither source held them, then what the terms that one of them holds add, then both
    base = own.join(other, "lang").where("source <> other").selectExpr(
        "lang", "source", "other", "v m", f"coalesce({nothing}, 0) x")
    one = entries.groupBy("lang", "source", "c").agg(F.count("*").alias("m"))
    one = one.join(own, ["lang", "source"]).selectExpr("lang", "source", "zero", "m", f"{_p('c', 'n', 'v')} p")
    here = one.join(other, "lang").where("source <> other").selectExpr(
        "lang", "source", "other", "m", f"{_f('p', 'other_zero')} - {nothing} x")
    there = one.selectExpr("lang", "source other", "zero other_zero", "m", "p q").join(own, "lang").where(
        "source <> other").selectExpr("lang", "source", "other", "m", f"{_f('zero', 'q')} - {nothing} x")
    cells = shared_cells(kept).groupBy("lang", "source", "other", "a", "b").agg(F.sum("m").alias("m"))
    cells = cells.join(own, ["lang", "source"]).join(other, ["lang", "other"]).selectExpr(
        "lang", "source", "other", "m", "zero", "other_zero", f"{_p('a', 'n', 'v')} p", f"{_p('b', 'other_n', 'v')} q")
    both = cells.unionByName(cells.selectExpr("lang", "other source", "source other", "m", "other_zero zero", "zero other_zero",
                                              "q p", "p q"))
    both = both.selectExpr("lang", "source", "other", "m",
                           f"{_f('p', 'q')} - {_f('p', 'other_zero')} - {_f('zero', 'q')} + {nothing} x")
    every = base.unionByName(here).unionByName(there).unionByName(both)
    high, low = _weighed("x")
    return (every.groupBy("lang", "source", "other").agg(F.expr(high), F.expr(low))
            .selectExpr("lang", "source", "other item", f"cast(cast(high as decimal(38, 0)) * {2**30} + low as long) value"))


def _terms(groups: DataFrame, entries: DataFrame, top: int) -> DataFrame:
    """lang, source, item, value, rank of the terms that a source uses more than its language does."""
    cells = entries.groupBy("lang", "source", "c", "total").agg(F.count("*").alias("m"))
    cells = cells.join(groups, ["lang", "source"]).selectExpr(
        "lang", "source", "c", "total", "m", f"{_p('c', 'n', 'v')} p", f"{_p('total', 'lang_n', 'v')} q").where("p > q")
    cells = materialize(cells.selectExpr("lang", "source", "c", "total", "m", f"{_f('p', 'q')} value"), "count-cells")
    down = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    values = cells.groupBy("lang", "source", "value").agg(F.sum("m").alias("m"))
    values = values.withColumn("r", F.row_number().over(down)).where(F.col("r") <= top)  # each value has a term at least
    above = F.sum("m").over(down.rowsBetween(Window.unboundedPreceding, -1))
    values = values.withColumn("above", F.coalesce(above, F.lit(0))).where(F.col("above") < top).drop("r", "m")
    chosen = cells.drop("m").join(values, ["lang", "source", "value"])
    ties = Window.partitionBy("lang", "source", "value").orderBy("term")
    return (entries.join(chosen, ["lang", "source", "c", "total"]).withColumn("r", F.row_number().over(ties))
            .where(F.col("r") <= top).withColumn("rank", F.col("above") + F.col("r")).where(F.col("rank") <= top)
            .select("lang", "source", F.col("term").alias("item"), "value", F.col("rank").cast("int").alias("rank")))


def divergence(docs: DataFrame, least: int = 3, top: int = 200) -> DataFrame:
    """lang, source, part, item, value, rank."""
    kept = materialize(kept_terms(docs, least), "kept-terms")
    entries = kept.select("lang", "term", F.col("n").alias("total"), F.explode("held").alias("h")).select(
        "lang", "term", "total", F.col("h.source").alias("source"), F.col("h.n").alias("c"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("lang_n"))
    sums = entries.groupBy("lang", "source").agg(F.sum("c").alias("n"))
    groups = docs.selectExpr("coalesce(cast(lang as string), '') lang", "coalesce(cast(source as string), '') name").distinct()
    groups = groups.withColumn("source", F.xxhash64("name"))
    groups = materialize(groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["n", "v", "lang_n"]), "groups")
    named = groups.select("lang", "source", "name")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair = _pairs(kept, groups, entries).join(named.selectExpr("lang", "source item", "name other"), ["lang", "item"])
    pair = pair.select("lang", "source", F.col("other").alias("item"), "value").withColumn("rank", F.row_number().over(order).cast("int"))
    shaped = [x.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
              for part, x in (("pair", pair), ("term", _terms(groups, entries, top)))]
    return shaped[0].unionByName(shaped[1]).join(named, ["lang", "source"]).select(
        "lang", F.col("name").alias("source"), "part", "item", "value", "rank")
