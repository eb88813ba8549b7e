"""Phrase collocations by SON partitioning.

Phrases of two to ``longest`` words are counted in each language, inside
pieces of text that end at punctuation or a line end.

1. Words are counted first, with their strings.  This also gives the number of
   words of each of ``SHARDS`` shards (a shard is the work of many tasks).
2. Each task counts its own phrases and sends them packed, keyed by the range
   of the phrase's hash.  A phrase travels as the hash of all but its last word
   and the hash of its last word, so it can be spelled later without a second
   look at the texts.  Pairs of words go first, then longer phrases.  A bit
   filter of the frequent words (then of the frequent pairs) holds back phrases
   that cannot be frequent; its size is bounded by ``FILTER_BITS``, and what it
   lets through by chance is only counted in vain.
3. A range of hashes is mined shard by shard, each completely, at the support
   lowered in proportion to the shard's share of all words.  A phrase with
   ``support`` occurrences has its share of them in one shard at least, so the
   union of what is frequent in some shard misses nothing; candidates are then
   counted over all shards, exactly.  Memory holds one shard's part of a range
   and the candidates; the number of ranges follows the number of words.
4. Frequent phrases are spelled by joins with the shorter ones, cut in two at
   every place, scored, and dropped where a longer one covers them.

The score of a cut into parts of l and r occurrences is floor(SCALE * a /
(l + r)), in decimals; the lowest cut counts, then the smallest first part.

Words and phrases are told apart by 64-bit hashes of language and words.
Defined results: a null text is empty, a null language is ``und``; repeated
rows count each; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import batches_of, byte_set, hash_words, lang_keys, mix, owners, shuffle_partitions, ship, text_buffers
from vigil.session import materialize

SCALE = 2_000_000
SHARDS = 10
HELD = 2_000_000       # phrases that a task holds before it sends their counts
RANGE = 1_000_000      # words of all texts for each range of hashes
HELD_WORDS = 400_000
FILTER_BITS = 30       # at most 2**30 bits, 128 MB; 64 bits for each key below that

PIECE_END = byte_set(*((ord(c),) * 2 for c in ".,;:!?"), (0x0A, 0x0D))
SPLIT = PIECE_END | byte_set((0x20, 0x20), (0x09, 0x09))
_FOLD = bytes(32 if SPLIT[b] else b + 32 if 65 <= b <= 90 else b for b in range(256))
_P = np.uint64(0xD6E8FEB86659FD93)

def joined(prefix: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of a phrase from those of its words but the last, and of its last word."""
    return mix(prefix * _P + last)


def word_keys(langs, column):
    """(hash of each word with its language, its piece) over all texts of a column."""
    data, offsets = text_buffers(column)
    h, first, starts, _ = hash_words(data, offsets, SPLIT, fold=True)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    ended = np.concatenate([[0], np.cumsum(PIECE_END[data])])
    return (mix(h ^ lang_keys(langs)[doc]) if len(h) else h), ended[starts] + doc


class Filter:
    """Which 64-bit keys are in a set: always right for those that are, mostly for the others."""

    def __init__(self, keys: DataFrame, column: str):
        self.bits = min(FILTER_BITS, max(20, (64 * keys.count()).bit_length()))
        last = (1 << self.bits) - 1
        at = F.explode(F.array(F.expr(f"({column} & {last}L) + 1"), F.expr(f"(shiftrightunsigned({column}, 32) & {last}L) + 1")))
        sets = (keys.select(at.alias("at")).groupBy(F.expr("bitmap_bucket_number(at) - 1").alias("at"))
                .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(at))").alias("bits")))
        self.set = np.zeros(1 << (self.bits - 3), np.uint8)
        for r in sets.toLocalIterator():
            self.set[r["at"] << 12:(r["at"] + 1) << 12] = np.frombuffer(r["bits"], np.uint8)

    def __call__(self, key: np.ndarray) -> np.ndarray:
        last, hit = np.uint64((1 << self.bits) - 1), np.ones(len(key), bool)
        for at in (key & last, (key >> np.uint64(32)) & last):
            hit &= (self.set[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return hit


def _selected(docs: DataFrame) -> DataFrame:
    return docs.selectExpr("coalesce(cast(lang as string), 'und') lang", "cast(text as string) text")


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, shard, n: occurrences of words (shard -1), and of all words of a shard (word null)."""
    ship(docs.sparkSession)

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, totals = TaskContext.get().partitionId() % SHARDS, defaultdict(Counter), Counter()

        def rows(lang, words, n, shard):
            k = len(words)
            return pa.RecordBatch.from_arrays([pa.array([lang] * k, pa.string()), words, pa.array([shard] * k, pa.int64()),
                                               pa.array(n, pa.int64())], names=["lang", "word", "shard", "n"])

        def sent() -> Iterator[pa.RecordBatch]:
            for lang, c in held.items():
                yield rows(lang, pa.array(list(c), pa.binary()).cast(pa.string()), list(c.values()), -1)
            held.clear()

        for batch in it:
            for part in batches_of(batch, "text", 1 << 20):
                for lang, text in zip(*(c.to_pylist() for c in part.columns)):
                    words = (text or "").encode().translate(_FOLD).split()
                    held[lang].update(words)
                    totals[lang] += len(words)
                if sum(map(len, held.values())) > HELD_WORDS:
                    yield from sent()
        yield from sent()
        for lang, n in totals.items():
            yield rows(lang, pa.array([None], pa.string()), [n], shard)

    return _selected(docs).mapInArrow(count, "lang string, word string, shard long, n long").groupBy(
        "lang", "word", "shard").agg(F.sum("n").alias("n"))


_PACKED = "part long, shard long, size long, prefix binary, last binary, n binary"


def phrase_counts(docs: DataFrame, parts: int, shortest: int, longest: int, wanted: Filter) -> DataFrame:
    """Counts of each task's phrases, packed by range of hashes: a row for each range, size and filling.

    ``wanted`` judges the words of pairs, and the pairs of words of longer phrases.
    """
    width = 1 if shortest == 2 else 2
    ship(docs.sparkSession)

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() % SHARDS
        waiting, held = defaultdict(list), 0

        def packed() -> Iterator[pa.RecordBatch]:
            for size, chunks in waiting.items():
                prefix, last = (np.concatenate(x) for x in zip(*chunks))
                key = joined(prefix, last)
                order = np.argsort(key, kind="stable")
                key = key[order]
                first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                n, key, order = np.diff(np.append(first, len(key))), key[first], order[first]
                at = np.concatenate([[0], np.flatnonzero(np.diff(owners(key, parts))) + 1, [len(key)]])
                owner = owners(key[at[:-1]], parts)
                columns = []
                for x in (prefix[order], last[order], n.astype(np.int64)):
                    raw = x.tobytes()
                    columns.append(pa.array([raw[8 * a:8 * b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary()))
                fixed = [pa.array(owner.astype(np.int64)), pa.array([shard] * len(owner), pa.int64()),
                         pa.array([size] * len(owner), pa.int64())]
                yield pa.RecordBatch.from_arrays(fixed + columns, names=[c.split()[0] for c in _PACKED.split(", ")])
            waiting.clear()

        for batch in it:
            for some in batches_of(batch, "text"):
                word, piece = word_keys(some.column(0).to_pylist(), some.column(1))
                unit = word if width == 1 else joined(word[:-1], word[1:])
                rare = np.concatenate([[0], np.cumsum(~wanted(unit))])
                prefix = word
                for size in range(2, longest + 1):
                    if len(word) < size:
                        break
                    prefix, last = prefix[:len(word) - size + 1], word[size - 1:]
                    if size >= shortest:
                        units = size - width + 1
                        inside = (piece[size - 1:] == piece[:len(piece) - size + 1]) & (rare[units:] == rare[:-units])
                        waiting[size].append((prefix[inside], last[inside]))
                        held += int(inside.sum())
                    prefix = joined(prefix, last)
                if held > HELD:
                    yield from packed()
                    held = 0
        if held:
            yield from packed()

    return _selected(docs).mapInArrow(count, _PACKED)


def _summed(key: np.ndarray, n: np.ndarray):
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(n[order], first)


def mine(shards: dict[int, list[tuple]], local: dict[int, int], support: int):
    """(prefix, last, n) of the phrases that occur ``support`` times in all shards together.

    ``shards``: for each shard its packed counts (prefix, last, n), each without a repeated phrase.
    """
    frequent = []
    for s, packs in shards.items():
        key, n = _summed(np.concatenate([joined(p, w) for p, w, _ in packs]), np.concatenate([n for *_, n in packs]))
        frequent.append(key[n >= local[s]])
    wanted = np.unique(np.concatenate(frequent))
    total, prefix, last = (np.zeros(len(wanted), t) for t in (np.int64, np.uint64, np.uint64))
    if len(wanted):
        for packs in shards.values():
            for p, w, n in packs:
                key = joined(p, w)
                at = np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)
                hit = wanted[at] == key
                at = at[hit]
                total[at] += n[hit]
                prefix[at], last[at] = p[hit], w[hit]
    good = total >= support
    return prefix[good], last[good], total[good]


def local_supports(sizes: dict[int, int], support: int) -> dict[int, int]:
    """Support of each shard in proportion to its size; a phrase that misses it in every shard misses ``support``."""
    n = max(1, sum(sizes.values()))
    return {s: max(1, math.ceil(support * sizes.get(s, 0) / n)) for s in range(SHARDS)}


def frequent_phrases(docs: DataFrame, support: int, shortest: int, longest: int, sizes: dict[int, int],
                     wanted: Filter) -> DataFrame:
    """size, phrase, prefix, last (hashes) and a (occurrences) of the phrases of ``shortest`` to ``longest`` words with
    ``support`` occurrences."""
    parts = max(shuffle_partitions(docs.sparkSession), math.ceil(sum(sizes.values()) / RANGE))
    local = local_supports(sizes, support)

    def mined(table: pa.Table) -> pa.Table:
        from vigil.llm.collocations import joined, mine

        out = []
        for size in sorted(set(table["size"].to_pylist())):
            shards = defaultdict(list)
            for batch in table.to_batches():
                for i in range(batch.num_rows):
                    if batch["size"][i].as_py() == size:
                        p, w, n = (np.frombuffer(batch[c][i].as_buffer(), t) for c, t in
                                   (("prefix", np.uint64), ("last", np.uint64), ("n", np.int64)))
                        shards[batch["shard"][i].as_py()].append((p, w, n))
            p, w, n = mine(shards, local, support)
            out.append(pa.table({"size": pa.array([size] * len(n), pa.int64()), "phrase": pa.array(joined(p, w).view(np.int64)),
                                 "prefix": pa.array(p.view(np.int64)), "last": pa.array(w.view(np.int64)), "a": pa.array(n)}))
        return pa.concat_tables(out)

    return (phrase_counts(docs, parts, shortest, longest, wanted).repartition(parts, "part").groupBy("part")
            .applyInArrow(mined, "size long, phrase long, prefix long, last long, a long"))


def _hashed(words: DataFrame) -> DataFrame:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from vigil.llm.collocations import word_keys

        for batch in it:
            key, _ = word_keys(batch.column(0).to_pylist(), batch.column(1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key.view(np.int64))], names=["lang", "word", "n", "w"])

    return words.select("lang", "word", "n").mapInArrow(run, "lang string, word string, n long, w long")


def spelled_phrases(docs: DataFrame, support: int = 30, longest: int = 4) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, a) of all words and phrases with ``support`` occurrences, and (lang, n) of all languages."""
    counted = word_counts(docs).where((F.col("shard") >= 0) | (F.col("n") >= support))
    counted = materialize(counted, "words")
    of_shard = counted.where("shard >= 0")
    # one row for each of the SHARDS shards
    sizes = {r["shard"]: r["n"] for r in of_shard.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    words = materialize(_hashed(counted.where("shard < 0")), "word-keys")
    found = materialize(frequent_phrases(docs, support, 2, min(2, longest), sizes, Filter(words, "w")), "pairs")
    if longest > 2:
        found = found.unionByName(materialize(
            frequent_phrases(docs, support, 3, longest, sizes, Filter(found, "phrase")), "phrases"))
    word = words.select(F.col("w").alias("last"), F.col("word").alias("end"))
    spelled = words.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("size"), F.col("n").alias("a"), F.col("w").alias("key"))
    tables = [spelled]
    for size in range(2, longest + 1):
        spelled = (found.where(F.col("size") == size).join(spelled.selectExpr("lang", "phrase start", "key prefix"), "prefix")
                   .join(word, "last").select("lang", F.concat_ws(" ", "start", "end").alias("phrase"), F.lit(size).alias("size"),
                                              "a", F.col("phrase").alias("key")))
        spelled = materialize(spelled, f"spelled-{size}")
        tables.append(spelled)
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t)
    return every.drop("key"), of_shard.groupBy("lang").agg(F.sum("n").alias("n"))


def collocations(docs: DataFrame, support: int = 30, longest: int = 4, top: int = 2000, cover: int = 80) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the ``top`` phrases of each language."""
    every, totals = spelled_phrases(docs, support, longest)
    phrases = every.where("size > 1").withColumn("words", F.split("phrase", " "))
    part = lambda start, n: F.array_join(F.slice("words", start, n), " ")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"),
        part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    scored = (cuts.join(every.selectExpr("lang", "phrase left", "a l"), ["lang", "left"])
              .join(every.selectExpr("lang", "phrase right", "a r"), ["lang", "right"])
              .withColumn("score", F.expr(f"cast({SCALE} as decimal(10, 0)) * cast(a as decimal(20, 0)) div "
                                          "(cast(l as decimal(20, 0)) + r)"))
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    # contiguous parts of two words or more of the longer phrases
    inner = phrases.where("size > 2").select("lang", "words", "size", F.col("a").alias("longer"),
                                             F.explode(F.expr("sequence(2, size - 1)")).alias("len"))
    inner = inner.withColumn("at", F.explode(F.expr("sequence(1, size - len + 1)"))).select(
        "lang", part(F.col("at"), F.col("len")).alias("phrase"), "longer").groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    wide = "decimal(30, 0)"
    covered = inner.join(every, ["lang", "phrase"]).where(
        F.lit(100) * F.col("longer").cast(wide) >= F.lit(cover) * F.col("a").cast(wide)).select("lang", "phrase")
    kept = scored.join(covered, ["lang", "phrase"], "left_anti").select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
