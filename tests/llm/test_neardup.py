import random

import numpy as np

from vigil.llm.components import components
from vigil.llm.neardup import T, near_duplicates, sketch

from .conftest import BASE


def sets(docs, k):
    out = {}
    for d, t in docs:
        w = "".join(c.lower() if c.isascii() else c for c in (t or "")).replace("\t", " ").replace("\n", " ").split(" ")
        w = [x for x in w if x]
        out[d] = frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])
    return out


def brute(docs, k=2):
    s = sets(docs, k)
    name = {d: d for d in s}

    def root(x):
        while name[x] != x:
            x = name[x]
        return x

    ids = sorted(s)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x = len(s[a] & s[b])
            if s[a] and s[b] and 100 * x >= 80 * (len(s[a]) + len(s[b]) - x):
                p, q = sorted((root(a), root(b)))
                name[q] = p
    return {d: (len(s[d]), root(d), root(d) == d) for d in s}


def edited(rng, base, n):
    w = base.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"z{rng.randrange(10**6)}"
    return " ".join(w)


def test_brute_force_on_a_group_near_the_threshold(spark):
    rng = random.Random(7)
    bases = [" ".join(f"w{rng.randrange(300)}" for _ in range(120)) for _ in range(3)]
    docs = [(i, edited(rng, bases[i % 3], rng.choice([0, 1, 4, 6, 8, 12]))) for i in range(240)]
    docs += [(1000 + i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 40)))) for i in range(60)]
    for k in (2, 5):
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
               for r in near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), k).collect()}
        assert got == brute(docs, k)


def test_real_table(spark, sf, documents):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
           for r in near_duplicates(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    assert got == brute(list(documents.items()))


def test_odd_documents(spark, odd_docs, no_docs):
    rows = near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert all(r.component_id == 1 and r.kept for r in by[1])          # a repeated row is its own copy
    assert (by[2][0].component_id, by[2][0].kept) == (1, False)
    assert (by[3][0].component_id, by[3][0].kept) == (1, False)
    for empty in (4, 5, 6):
        assert (by[empty][0].n_shingles, by[empty][0].component_id, by[empty][0].kept) == (0, empty, True)
    assert {(r.n_shingles, r.component_id, r.kept) for r in by[None]} == {(0, None, True), (len(sets([(0, BASE + " again")], 2)[0]), 1, False)}
    assert by[10][0].n_shingles == 1
    assert near_duplicates(no_docs).count() == 0


def test_sketch_fills_and_estimates(spark):
    rng = np.random.default_rng(1)
    for n in (1, 2, 30, 5000):
        assert (sketch(np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))) != 2**64 - 1).all()
    x = rng.integers(0, 2**63, 300, dtype=np.uint64)
    a, b = np.unique(x[:270]), np.unique(x[30:])
    assert abs((sketch(a) == sketch(b)).mean() - 240 / 300) < 4 * (0.16 / T) ** 0.5


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, x) for x in range(101, 130)] + [(200, 201), (201, 202), (202, 200), (5, 5)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(1, 41)} == {1}
    assert {got[i] for i in range(100, 130)} == {100} and {got[i] for i in (200, 201, 202)} == {200}


def varied(seed, variants=250, pairs=40, size=140, edits=7):
    """A text with many variants, parts of a variant that are just like it, and parts of those."""
    rng = random.Random(seed)
    base = [f"g{seed}w{i}" for i in range(size)]
    texts = [base]
    for _ in range(variants):
        w = list(base)
        for at in rng.sample(range(size), edits):
            w[at] = f"g{seed}v{rng.randrange(10**6)}"
        texts.append(w)
    for _ in range(pairs):
        x = rng.choice(texts[1:variants + 1])
        for _ in range(2):
            n = -(-8 * (len(x) - 1) // 10)
            a = rng.randrange(len(x) - n)
            x = x[a:a + n + 1]
            texts.append(x)
    return [(1000 * seed + i, " ".join(w)) for i, w in enumerate(texts)]


def test_outsiders_meet_what_their_component_took_in(spark):
    docs = varied(0) + varied(1)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
           for r in near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute(varied(0)) | brute(varied(1))


def test_narrow_tables_take_few_files_however_many_partitions_are_shuffled(spark, tmp_path):
    rng = random.Random(11)
    base = " ".join(f"w{rng.randrange(300)}" for _ in range(120))
    docs = [(i, edited(rng, base, rng.choice([0, 1, 4, 8, 12]))) for i in range(60)]
    asked, conf = {"spark.sql.shuffle.partitions": "96", "spark.sql.adaptive.coalescePartitions.enabled": "false"}, spark.conf
    before, at = {k: conf.get(k) for k in asked}, spark.sparkContext.getCheckpointDir()
    try:
        for k, v in asked.items():
            conf.set(k, v)
        spark.sparkContext.setCheckpointDir(str(tmp_path))
        df = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}
    finally:
        for k, v in before.items():
            conf.set(k, v)
        spark.sparkContext.setCheckpointDir(at)
    files = [len(list(p.glob("part-*"))) for p in tmp_path.glob("*/vigil/*")]
    assert got == brute(docs)
    assert len(files) > 15 and max(files) <= max(96 // 8, 2 * spark.sparkContext.defaultParallelism)
