import random
import re
from collections import Counter, defaultdict

import numpy as np

from vigil.llm.collocations import SHARDS, Filter, collocations, joined, local_supports, mine

SCHEMA = "doc_id long, text string, lang string"


def brute(docs, support=30, top=2000):
    f = defaultdict(Counter)
    for _, text, lang in docs:
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 5):
                f[lang or "und"].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        n = sum(v for p, v in c.items() if len(p) == 1)
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= support}
        rows = []
        for p, a in found.items():
            if any(100 * b >= 80 * a and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in found.items()):
                continue
            score, k = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), " ".join(p), c[p[:k]], c[p[k:]]))
        out += [(lang, r, p, -a, x, y, n, -s) for r, (s, a, _, p, x, y) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def rows(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def corpus(n=600):
    rng = random.Random(5)
    vocabulary = ["New", "york", "city", "new", "the", "of", "é", "a\x0bb", "x-y"]
    return [(i, rng.choice([" ", "\t", ", "]).join(rng.choice(vocabulary) for _ in range(rng.randrange(25))),
             rng.choice(["en", "de", None])) for i in range(n)] + [(n, None, "en"), (n + 1, "", "fr"), (n + 2, "alone", "fr")]


def test_brute_force(spark, monkeypatch):
    docs = corpus()
    df = spark.createDataFrame(docs, SCHEMA)
    assert rows(collocations(df)) == brute(docs)
    assert rows(collocations(df, top=7)) == brute(docs, top=7)
    monkeypatch.setattr("vigil.llm.collocations.HELD", 100)
    assert rows(collocations(df.repartition(23), support=12)) == brute(docs, support=12)


def test_odd_rows(spark, odd_docs, no_docs):
    docs = [(r.doc_id, r.text, r.lang) for r in odd_docs.collect()]
    assert rows(collocations(odd_docs, support=2)) == brute(docs, support=2)
    assert collocations(no_docs).collect() == []


def test_a_shard_by_shard_search_misses_nothing():
    rng = np.random.default_rng(2)
    word = rng.integers(1, 2**62, 40, dtype=np.uint64)
    shards, counts = {}, Counter()
    for s in range(SHARDS):
        picks = Counter((int(a), int(b)) for a, b in rng.integers(0, 40, (30 * (s + 1), 2)) // (1 + s % 3))
        counts.update(picks)
        pairs = sorted(picks)
        shards[s] = [(word[[a for a, _ in part]], word[[b for _, b in part]], np.array([picks[p] for p in part], np.int64))
                     for part in (pairs[::2], pairs[1::2])]
    sizes = {s: 30 * (s + 1) for s in range(SHARDS)}
    local = local_supports(sizes, 8)
    assert sum(max(0, local[s] - 1) for s in local) < 8
    p, w, n = mine(shards, local, 8)
    got = {(int(a), int(b)): int(c) for a, b, c in zip(p, w, n)}
    assert got == {(int(word[a]), int(word[b])): c for (a, b), c in counts.items() if c >= 8}


def test_filter_keeps_all_its_keys(spark):
    rng = np.random.default_rng(1)
    keys = rng.integers(-2**63, 2**63 - 1, 5000)
    f = Filter(spark.createDataFrame([(int(k),) for k in keys], "k long"), "k")
    assert f(keys.view(np.uint64)).all()
    assert f(rng.integers(0, 2**63, 20_000).astype(np.uint64)).mean() < 0.01
    none = Filter(spark.createDataFrame([], "k long"), "k")
    assert not none(joined(keys.view(np.uint64), keys.view(np.uint64))).any()
