"""MinHash near-duplicates with fast similarity sketching.

Each document's set of word shingles gets a sketch of ``t`` coordinates: in
round i every shingle is thrown into a hashed bin with the value (i, hash), in
round t + j into bin j, and a bin keeps its smallest value.  Later rounds have
larger values, so rounds stop once every bin is filled, which takes about
t ln t throws whatever the size of the set, and always happens.

Links (Jaccard of the full sets at or over ``percent``) are found in steps that
never list the pairs of a group:

1. documents with one set form a class; only classes go on,
2. band keys over the sketch make buckets; a bucket of one class is dropped,
3. each class is compared with the bucket centre that it shares most bands with,
4. in each bucket, classes outside its largest component so far are compared
   with all members of that component, and
5. what stays outside is compared among itself and with what step 4 took in,
   which wasn't in the component when the outsiders were compared with it.

Steps 4 and 5 work on blocks of ``BLOCK`` sets by counting common shingles
through an inverted index inside a task; a block gives the links that join two
components.  Every pair that shares a bucket is thus in one component or has
been compared on full sets.  With 56 bands of 6 coordinates a pair at exactly
0.8 shares no bucket with probability 4e-8.

Sets are 64-bit hashes of all shingles of the whole text.  A class is named by
64 bits of its set's hash and told apart by a second 64 bits and its size.

Defined results: null, empty and wordless texts have no set, are linked with
nothing and kept; a text of fewer words than a shingle is one shingle; repeated
rows are members of one class; null ids are never a component's name unless
all ids of the component are null; an empty table gives no rows; extra columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import SPACE, batches_of, hash_words, mix, only, phrase_hashes, ship, text_buffers
from vigil.llm.components import components
from vigil.session import BROAD, NARROW, materialize

ROWS, BANDS = 6, 56
T = ROWS * BANDS
BLOCK = 512
_rng = np.random.default_rng(0xB1D5)
_SEEDS = _rng.integers(1, 2**63, 2 * T, dtype=np.uint64)
_MULT = _rng.integers(1, 2**63, ROWS, dtype=np.uint64) | np.uint64(1)
_BAND = _rng.integers(1, 2**63, BANDS, dtype=np.uint64)
_EMPTY = np.uint64(2**64 - 1)


def sketch(a: np.ndarray) -> np.ndarray:
    """The T coordinates of a set of uint64 hashes (not empty)."""
    s, done = np.full(T, _EMPTY, np.uint64), 0
    rounds = max(1, int(1.3 * T * np.log(T) / len(a)) + 1)
    while done < 2 * T:
        n = min(rounds, 2 * T - done, max(1, (1 << 20) // len(a)))
        number = np.arange(done, done + n)
        x = mix(a[None, :] ^ _SEEDS[number][:, None])
        bins = np.where(number[:, None] < T, (x >> np.uint64(32)) % np.uint64(T), (number[:, None] - T) % T)
        values = (number.astype(np.uint64) << np.uint64(32))[:, None] | (x & np.uint64(0xFFFFFFFF))
        np.minimum.at(s, bins.ravel().astype(np.intp), values.ravel())
        done += n
        if (s != _EMPTY).all():
            break
    return s


def band_keys(s: np.ndarray) -> np.ndarray:
    return mix((mix(s).reshape(BANDS, ROWS) * _MULT).sum(axis=1, dtype=np.uint64) + _BAND).view(np.int64)


def shingle_sets(column, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text (A-Z lower-cased, words between white space)."""
    data, offsets = text_buffers(column)
    h, first, _, _ = hash_words(data, offsets, SPACE, fold=True)
    g = phrase_hashes(h, k)
    for a, z in zip(first[:-1].tolist(), first[1:].tolist()):
        if z - a >= k:
            yield np.unique(g[a:z - k + 1])
        elif z > a:  # fewer words than a shingle: the sequence itself
            yield phrase_hashes(h[a:z], z - a) + np.uint64(z - a)
        else:
            yield h[:0]


def names(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit names of a set."""
    with np.errstate(over="ignore"):
        a = mix(np.array([s.sum(dtype=np.uint64) + np.uint64(len(s))], np.uint64))
        b = mix(np.array([mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)], np.uint64))
    return int(a.view(np.int64)[0]), int(b.view(np.int64)[0])


def _sketched(docs: DataFrame, k: int) -> DataFrame:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        for batch in it:
            for part in batches_of(batch, "text"):
                n, node, check, bands = [], [], [], []
                for s in shingle_sets(part.column(2), k):
                    n.append(len(s))
                    a, b = names(s) if len(s) else (None, None)
                    node.append(a)
                    check.append(b)
                    bands.append(band_keys(sketch(s)) if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(node, pa.int64()),
                     pa.array(check, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                    names=["doc_id", "text_hash", "n", "node", "twin", "bands"])

    return docs.mapInArrow(run, "doc_id long, text_hash long, n long, node long, twin long, bands array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(node, n, items) of the wanted classes, from the text of their first document."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for part in batches_of(batch, "text"):
                rows = [(w, len(s), s.view(np.int64)) for w, s in zip(part.column(0).to_pylist(), shingle_sets(part.column(1), k))
                        if len(s) and names(s)[0] == w]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                        zip(*rows), (pa.int64(), pa.int64(), pa.list_(pa.int64())))], names=["node", "n", "items"])

    return (docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("rep"))).select("node", "text")
            .mapInArrow(run, "node long, n long, items array<long>").dropDuplicates(["node"]))


def _block_links(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the sides of each block.

    ``rows``: group, i, j (the block), side (0 or 1), node, label.  A link is
    given when it joins two sets of already connected nodes of the block.
    """
    def run(key, batch_table):
        t = batch_table.combine_chunks()
        side, node, label = (t.column(c).to_numpy() for c in ("side", "node", "label"))
        items = t.column("items").combine_chunks() if isinstance(t.column("items"), pa.ChunkedArray) else t.column("items")
        off, flat = items.offsets.to_numpy(), items.values.to_numpy()
        sizes = np.diff(off)
        base = np.flatnonzero(side == 1)
        own = np.repeat(base, sizes[base])
        vals = np.concatenate([flat[off[i]:off[i + 1]] for i in base]) if len(base) else flat[:0]
        order = np.argsort(vals, kind="stable")
        vals, own = vals[order], own[order]
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        out = []
        for q in np.flatnonzero(side == 0).tolist():
            s = flat[off[q]:off[q + 1]]
            lo, hi = np.searchsorted(vals, s, "left"), np.searchsorted(vals, s, "right")
            n = hi - lo
            if not n.sum():
                continue
            at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
            common = np.bincount(own[at], minlength=len(side))
            for y in np.flatnonzero((common > 0) & (100 * common >= percent * (sizes + len(s) - common))).tolist():
                a, b = root(int(label[q])), root(int(label[y]))
                if a != b:
                    parent[a] = b
                    out.append((int(node[q]), int(node[y])))
        return pa.table([pa.array([o[i] for o in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return (rows.join(sets.select("node", "items"), "node").groupBy("group", "i", "j")
            .applyInArrow(run, "a long, b long"))


def near_duplicates(docs: DataFrame, k: int = 2, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, text_hash."""
    spark = docs.sparkSession
    ship(spark)
    d = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    rows = materialize(_sketched(d.selectExpr("doc_id", "xxhash64(text) text_hash", "text"), k), "sketches")
    classes = materialize(rows.where("node is not null").groupBy("node", "twin", "n").agg(F.min("doc_id").alias("rep")), "classes", NARROW)

    # buckets of several classes; one member of each class stands for it
    first = rows.join(classes.select("node", "twin", "rep"), ["node", "twin"]).where("doc_id <=> rep").select("node", "bands")
    member = materialize(first.select("node", F.explode("bands").alias("bucket")).distinct(), "bands", BROAD)
    centre = materialize(member.groupBy("bucket").agg(F.count("*").alias("m"), F.min("node").alias("centre"))
                         .where("m > 1").select("bucket", "centre"), "buckets", BROAD)
    member = materialize(member.join(centre, "bucket"), "members", BROAD)
    wanted = member.select("node").distinct().join(classes.select("node", "rep"), "node")
    sets = materialize(_sets(d, wanted, k), "sets", BROAD)

    # 3: the centre that a class shares most buckets with
    tried = (member.where("node <> centre").groupBy("node", "centre").agg(F.count("*").alias("shared"))
             .groupBy("node").agg(F.max_by("centre", F.struct("shared", "centre")).alias("centre")))
    tried = materialize(tried, "pairs", NARROW)
    x, y = sets.selectExpr("node", "n xn", "items xs"), sets.selectExpr("node centre", "n yn", "items ys")
    common = F.size(F.array_intersect("xs", "ys"))
    links = materialize(tried.join(x, "node").join(y, "centre").where(
        100 * common >= percent * (F.col("xn") + F.col("yn") - common)).select(
        F.col("node").alias("a"), F.col("centre").alias("b")), "links", BROAD)
    labels = components(links)

    def labelled(frame: DataFrame, labels: DataFrame) -> DataFrame:
        return frame.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))

    # 4: buckets with several components; everything outside the largest one against all of it
    at = materialize(labelled(member.select("bucket", "node"), labels), "at", BROAD)
    weight = F.struct("w", "label")
    parts = at.groupBy("bucket", "label").agg(F.count("*").alias("w"))
    target = materialize(parts.groupBy("bucket").agg(F.count("*").alias("parts"), F.max_by("label", weight).alias("target"))
                         .where("parts > 1").select("bucket", "target"), "targets", NARROW)
    asks = materialize(at.join(target, "bucket").where("label <> target")
                       .groupBy("target", "node").agg(F.min("label").alias("label")), "asks", NARROW)
    held = materialize(labelled(sets.select("node"), labels).withColumnRenamed("label", "target")
                       .join(asks.select("target").distinct(), "target"), "held", NARROW)
    queries = asks.groupBy("target").agg(F.count("*").alias("q"))
    sizes = materialize(held.groupBy("target").agg(F.count("*").alias("m")).join(queries, "target")
                        .select("target", F.ceil(F.col("q") / BLOCK).cast("int").alias("qi"),
                                F.ceil(F.col("m") / BLOCK).cast("int").alias("mj")), "sizes", NARROW)

    def block(frame: DataFrame, sizes: DataFrame, count: str, other: str, side: int) -> DataFrame:
        """Each node in its own block of one side, beside every block of the other."""
        own = F.pmod(F.xxhash64("node"), F.col(count)).cast("int")
        e = frame.join(sizes, "target").withColumn("o", own).withColumn(
            "x", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        i, j = ("o", "x") if side == 0 else ("x", "o")
        return e.select(F.col("target").alias("group"), F.col(i).alias("i"), F.col(j).alias("j"),
                        F.lit(side).alias("side"), "node", "label")

    first = block(asks, sizes, "qi", "mj", 0).unionByName(
        block(held.withColumn("label", F.col("target")), sizes, "mj", "qi", 1))
    found = materialize(_block_links(first, sets, percent), "links", BROAD)
    labels = components(links.unionByName(found))

    # 5: what is still outside, among itself and with the others that asked the same component
    now = labels.select(F.col("node").alias("target"), F.col("label").alias("target_label"))
    asked = materialize(labelled(asks.drop("label"), labels).join(now, "target", "left")
                        .withColumn("outside", F.col("label") != F.coalesce("target_label", "target"))
                        .select("target", "node", "label", "outside"), "asked", NARROW)
    sizes = materialize(asked.groupBy("target").agg(
        F.count_if("outside").alias("q"), F.count("*").alias("m"), F.min("label").alias("lo"), F.max("label").alias("hi"))
        .where("q > 0 and lo <> hi").select("target", F.ceil(F.col("q") / BLOCK).cast("int").alias("qi"),
                                            F.ceil(F.col("m") / BLOCK).cast("int").alias("mj")), "sizes", NARROW)
    left = block(asked.where("outside"), sizes, "qi", "mj", 0)
    right = block(asked, sizes, "mj", "qi", 1)
    more = materialize(_block_links(left.unionByName(right), sets, percent), "links", BROAD)
    if more.limit(1).count():
        labels = components(links.unionByName(found).unionByName(more))

    # a component's name is its smallest id
    lowest = labels.join(classes.select("node", "rep"), "node").groupBy("label").agg(F.min("rep").alias("low"))
    named = materialize(classes.join(labels, "node", "left").join(lowest, "label", "left")
                        .select("node", "twin", F.coalesce("low", "rep").alias("component")), "components", NARROW)
    out = rows.select("doc_id", "text_hash", "n", "node", "twin").join(named, ["node", "twin"], "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"), "text_hash")
