import hashlib
import re

from vigil.llm.decontaminate import decontaminate

W = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return W.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items):
    out = {}
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for i, it in items:
            iw = words(it)
            k = min(10, len(iw))
            for a in range(len(iw) - k + 1 if k else 0):
                for b in range(len(w) - k + 1):
                    if w[b:b + k] == iw[a:a + k]:
                        hit.update(range(b, b + k))
                        ids.add(i)
        out[d] = (len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest(), bool(hit))
    return out


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


ITEMS = [(1, "What is the capital of the small country far away from here now?"), (2, "Short item"), (3, None), (4, " .,"),
         (10, "É à ü words beyond ASCII"), (2, "other text of item two")]
DOCS = [(1, "x WHAT is, the capital of the small; country far away from here now! y short-item"), (2, None), (3, ""),
        (4, "what is the capital of the small country far"), (5, "é à ü words beyond ascii É à ü words beyond ascii"),
        (6, "shorts item short items")]


def test_brute_force(spark):
    docs, items = frame(spark, DOCS, "doc_id long, text string"), frame(spark, ITEMS, "item_id long, text string")
    want = brute(DOCS, ITEMS)
    for blocks in (10**6, 40):  # one automaton, and several in turn
        got = {r.doc_id: tuple(r)[1:] for r in decontaminate(docs, items, block_chars=blocks).collect()}
        # a non-ASCII capital isn't folded, as the rule folds A-Z alone
        assert got == want


def test_spans_point_into_the_original(spark):
    docs, items = frame(spark, DOCS, "doc_id long, text string"), frame(spark, ITEMS, "item_id long, text string")
    rows = {r.doc_id: r.spans for r in decontaminate(docs, items, with_spans=True).collect()}
    text = dict(DOCS)[1]
    assert [text[s.start:s.end] for s in rows[1]] == [text[2:text.index("!")], "short-item"]


def test_real_tables(spark, sf, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    windows = {}
    for i, t in items:
        w = words(t)
        k = min(10, len(w))
        for a in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[a:a + k]), set()).add(i)
    got = {r.doc_id: r for r in decontaminate(spark.read.parquet(f"{sf}/documents.parquet"),
                                              spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    for d, t in documents.items():
        w, hit = words(t), set()
        for k in {len(x) for x in windows}:
            for b in range(len(w) - k + 1):
                if tuple(w[b:b + k]) in windows:
                    hit.update(range(b, b + k))
        assert (got[d].n_words, got[d].n_hit) == (len(w), len(hit))


def test_odd_documents_and_empty_tables(spark, odd_docs, no_docs):
    items = frame(spark, ITEMS, "item_id long, text string")
    assert decontaminate(odd_docs, items).count() == odd_docs.count()
    assert decontaminate(no_docs, items).count() == 0
    clean = decontaminate(odd_docs, items.limit(0), columns=odd_docs.columns)
    assert clean.where("contaminated").count() == 0
    assert clean.select("row.*").columns == odd_docs.columns
