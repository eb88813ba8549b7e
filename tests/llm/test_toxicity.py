import random

import numpy as np
import pytest

from vigil.llm.toxicity import Automaton, Settings, budget, features, fit, score
from pyspark.sql import functions as F


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(5)
    lexicon = ["idiot", "worthless", "scum", "ñandú", "abc", "stupidly"]
    words = ["".join(rng.choice("idotscumabcñwrhle") for _ in range(rng.randrange(1, 11))) for _ in range(300)]
    for w in lexicon:  # misspellings
        for _ in range(60):
            x = list(w)
            for _ in range(rng.randrange(0, 4)):
                k = rng.randrange(len(x) + 1)
                x[k:k + rng.randrange(0, 2)] = rng.choice(["", "x", "i"])
            words.append("".join(x) or "q")
    got = Automaton(lexicon, []).match(words)
    for w, g in zip(words, got):
        d = [(distance(w, e), budget(len(e), False)) for e in lexicon]
        want = 1 if w in lexicon else 3 if any(x <= k for x, k in d) else 0
        assert g == want, (w, g, want)


def test_stems_hold_whatever_follows():
    got = Automaton(["scum"], ["loweii", "vequ"]).match(["vequxyz", "vequ", "veq", "loweiischaft", "lowiischaft", "xxscum", "scumm"])
    assert got.tolist() == [2, 2, 0, 2, 4, 0, 3]


def test_context_weighs_quotations_less():
    a, s = Automaton(["idiot", "moron"], []), Settings()
    plain, quoted, said, beside = (features(t, {}, a, s)[0] for t in (
        "he is an idiot", 'he read "an idiot" there', "someone said idiot", "you idiot and moron"))
    assert quoted < plain and said < plain < beside
    assert features("nothing here", {}, a, s) == [0.0] * 5


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice(["ba", "de", "ki", "lo", "mu", "ra"]) for _ in range(rng.randrange(1, 5)))
    docs, labels = [], []
    for d in range(1500):
        toxic = int(d % 5 == 0)
        ws = [word() for _ in range(rng.randrange(5, 60))]
        for _ in range(2 * toxic):
            t = rng.choice(["worthless", "stupid", "pathetic"])
            ws.insert(rng.randrange(len(ws)), t if rng.random() < 0.8 else t[:3] + t[4:])
        docs.append((d, " ".join(ws)))
        labels.append((d, toxic))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy(spark, corpus):
    docs, labels = corpus
    model = fit(docs, labels)
    assert {"worthless", "stupid", "pathetic"} <= set(model.words)
    rows = docs.join(labels, "doc_id").where("crc32(cast(doc_id as string)) % 5 = 0").select(
        "toxic", score(spark, model)(F.col("text")).alias("s")).collect()
    right = np.mean([(r.s >= 0.5) == bool(r.toxic) for r in rows])
    assert len(rows) > 200 and right > 0.98


def test_labels_of_held_out_rows_are_never_read(spark, corpus):
    docs, labels = corpus
    flipped = labels.withColumn("toxic", F.when(F.expr("crc32(cast(doc_id as string)) % 5 = 0"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = fit(docs, labels), fit(docs, flipped)
    assert (a.words, a.stems) == (b.words, b.stems) and np.allclose(a.weights, b.weights)


def test_odd_documents(spark, corpus, odd_docs, no_docs):
    docs, labels = corpus
    nulls = spark.createDataFrame([(None, 1), (3, None)], "doc_id long, toxic int")
    model = fit(docs, labels.unionByName(nulls))
    toxic = score(spark, model)
    rows = odd_docs.select("doc_id", toxic(F.col("text")).alias("s")).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.s < 0.5 for r in rows)
    assert no_docs.select(toxic(F.col("text"))).count() == 0
    none = fit(no_docs, labels.limit(0))  # nothing to learn from
    assert {r.s for r in odd_docs.select(score(spark, none)(F.col("text")).alias("s")).collect()} == {0.0}
