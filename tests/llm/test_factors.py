import random

from vigil.llm.factors import remove_repeats


def brute(docs, n=20):
    seen, out = set(), {}
    for d, t in sorted(docs):
        w = [x for x in (t or "").replace("\n", " ").replace("\t", " ").split(" ") if x]
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            k = tuple(w[i:i + n])
            if k in seen:
                gone[i:i + n] = [True] * n
            seen.add(k)
        out[d] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def result(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in remove_repeats(df).collect()}


def test_brute_force_on_planted_passages(spark):
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(50)}"
    passages = [[word() for _ in range(n)] for n in (19, 20, 21, 45, 80)]
    docs = []
    for d in range(80):
        w = []
        for _ in range(rng.randrange(0, 4)):
            w += [word() for _ in range(rng.randrange(0, 30))]
            p = rng.choice(passages)
            a = rng.randrange(0, 6)
            w += p[a:] if rng.random() < 0.5 else p
        docs.append((d, rng.choice([" ", "\n"]).join(w)))
    docs += [(500, " ".join(["same"] * 70)), (501, "a b " * 40)]  # windows that overlap their own copies
    assert result(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)) == brute(docs)


def test_real_table(spark, sf, documents):
    assert result(spark.read.parquet(f"{sf}/documents.parquet")) == brute(list(documents.items()))


def test_odd_documents(spark, odd_docs, no_docs):
    rows = remove_repeats(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    # a null id comes first: its text is the source of the passages of 1, 2 and 3
    source = max(by[None], key=lambda r: r.n_words)
    assert (source.n_removed, min(r.n_words for r in by[None])) == (0, 0)
    assert all(r.n_removed == r.n_words and r.kept_text == "" for r in by[1] + by[2])
    assert by[3][0].n_removed == by[3][0].n_words - 1 and by[3][0].kept_text == "mountains"
    assert [(s.start, s.end) for s in by[3][0].spans] == [(0, by[3][0].n_words - 1)]
    assert (by[4][0].n_words, by[5][0].n_words, by[6][0].n_words) == (0, 0, 0)
    assert remove_repeats(no_docs).count() == 0


def test_repeated_rows_are_one_document(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = remove_repeats(spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string").repartition(2)).collect()
    assert [(r.n_words, r.n_removed) for r in rows] == [(30, 0), (30, 0)]
