import random
import re
from collections import Counter, defaultdict

from vigil.llm.divergence import divergence

SCHEMA = "doc_id long, text string, lang string, source string"


def brute(docs, least=3, top=200):
    """Every kept term for every pair, one by one."""
    n, df, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in docs:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        n[lang, source].update(words)
        df[lang].update(set(words))
    out = set()
    for lang in {x for x, _ in groups}:
        kept = sorted(t for t, c in df[lang].items() if c >= least)
        sources = sorted(s for x, s in groups if x == lang)

        def ps(count):
            total = sum(count(t) for t in kept) + len(kept)
            return {t: 1 + 10**9 * (count(t) + 1) // total for t in kept}

        p = {s: ps(lambda t, s=s: n[lang, s][t]) for s in sources}
        q = ps(lambda t: sum(n[lang, s][t] for s in sources))
        for s in sources:
            pair = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            term = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if n[lang, s][t] and p[s][t] > q[t]]
            for part, rows, most in (("pair", pair, len(pair)), ("term", term, top)):
                for r, (v, item) in enumerate(sorted(rows, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    out.add((lang, s, part, item, v, r))
    return out


def rows(df):
    found = [(r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect()]
    assert len(found) == len(set(found))
    return set(found)


def corpus():
    rng = random.Random(3)
    out = []
    for i in range(400):
        lang, source = rng.choice(["en", "en", "en", "zz", None]), rng.choice(["a"] * 4 + ["b", "c", "", None])
        words = [rng.choice(["The", "of", "É", "é", "x" * rng.randrange(1, 9), f"w{'abcdefgh'[rng.randrange(8)]}"]) for _ in range(rng.randrange(30))]
        out.append((i, rng.choice([" ", "-", "1"]).join(words), lang, source))
    return out + [(900, "once only here", "solo", "a"), (901, None, "solo", "b"), (902, "", "empty", "a")]


def test_brute_force(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, SCHEMA)
    assert rows(divergence(df)) == brute(docs)
    assert rows(divergence(df, top=5)) == brute(docs, top=5)  # ties at the last rank
    assert rows(divergence(df, least=10**6)) == brute(docs, least=10**6)  # no term kept


def test_odd_rows_and_fillings(spark, odd_docs, no_docs, monkeypatch):
    docs = [(r.doc_id, r.text, r.lang, r.source) for r in odd_docs.collect()]
    assert rows(divergence(odd_docs)) == brute(docs)
    assert divergence(no_docs).collect() == []
    monkeypatch.setattr("vigil.llm.divergence.HELD", 50)
    assert rows(divergence(odd_docs.select("text", "source", "lang").repartition(5))) == brute(docs)


def test_counts_past_64_bits(spark):
    from vigil.llm.divergence import _p

    got = spark.range(1).selectExpr(f"{_p('c', 'n', 'v')} p".replace("c + 1", "9999999999999L + 1").replace(
        "if(c <", "if(9999999999999L <").replace("n + v", "10000000000000L + 5L")).first().p
    assert got == 1 + 10**9 * 10**13 // (10**13 + 5)
