import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vigil.llm.quality import judge, measure
from vigil.llm.vocab import PieceBpe, vocabulary
from vigil.session import materialize

W = re.compile(r"[^\x20\x09-\x0D]+")


def base(t):
    t = t or ""
    w = W.findall(t)
    n = len(w)
    windows = Counter(tuple(w[i:i + 5]) for i in range(n - 4))
    repeated = {j for i in range(n - 4) if windows[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in t.split("\n") if W.search(x)]
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeated),
            n < 10 or 100 * len(repeated) > 20 * n)


@pytest.fixture(scope="module")
def judged(spark, sf):
    return judge(materialize(measure(spark.read.parquet(f"{sf}/documents.parquet")), "quality"))


def test_base_counts(judged, documents):
    for r in judged.collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(documents[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_measures_equal_the_tokenizer(judged, documents):
    bpe = PieceBpe(vocabulary("piece_bpe_32k.model"))
    for r in judged.orderBy("doc_id").limit(60).collect():
        text = re.sub(r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*", " ", documents[r.doc_id] or "")
        ids = bpe.sp.encode(" ".join(text.split()))
        assert r.n_tokens == len(ids)
        if ids:
            assert r.chars_per_token == pytest.approx(len("".join(text.split())) / len(ids))
            assert r.byte_share == pytest.approx(sum(map(bpe.sp.is_byte, ids)) / len(ids))


def test_labelled_junk_goes_and_clean_text_stays(spark):
    d = "/root/testdata/sf0.01"
    rows = (judge(materialize(measure(spark.read.parquet(f"{d}/documents.parquet")), "quality"))
            .join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("not base_failed").collect())
    kept = {q: [r.kept for r in rows if r.quality == q] for q in (0, 1)}
    assert sum(kept[1]) / len(kept[1]) > 0.95 and sum(kept[0]) / len(kept[0]) < 0.15


def test_odd_documents(odd_docs, no_docs):
    rows = judge(materialize(measure(odd_docs), "quality")).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows}
    for d in (4, 5, 6):
        assert (by[d].n_words, by[d].n_tokens, by[d].kept, by[d].base_failed) == (0, 0, False, True)
    assert by[9].n_words == 60_000 and by[10].word_chars == 300_000
    empty = judge(materialize(measure(no_docs), "quality"))
    assert empty.count() == 0 and "kept" in empty.columns


def test_scripts_have_their_own_bands(spark):
    text = "слова этого текста написаны другим письмом и байты здесь обычны потому что словарь мал"
    rows = [(i, f"{text} {i} {'и ' * (i % 3)}", "ru") for i in range(60)] + [
        (100 + i, "plain words of a common language that the vocabulary knows well enough for this " * 1 + f"x{i}", "en") for i in range(60)]
    out = judge(materialize(measure(spark.createDataFrame(rows, "doc_id long, text string, lang string")), "quality"))
    assert out.where(F.col("doc_id") < 100).where("kept").count() >= 55


def test_rare_languages_and_lengths_are_not_judged_by_others(spark):
    rng = random.Random(5)
    english = "plain words of common language that vocabulary knows well enough for this and other texts about them".split()
    russian = "слова этого текста написаны другим письмом и байты здесь обычны потому что словарь мал".split()
    text = lambda words, n: " ".join(rng.choice(words) + "." * (rng.random() < 0.1) for _ in range(n))
    rows = [(i, text(english, rng.randrange(40, 60)), "en") for i in range(200)]
    rows += [(1000 + i, text(russian, 50), "ru") for i in range(12)]                      # a rare language
    rows += [(2000 + i, text(russian, rng.randrange(45, 55)), "uk") for i in range(60)]
    rows += [(3000 + i, text(russian, n), "uk") for i, n in enumerate([14, 16, 300, 900])]  # rare lengths
    rows += [(4000 + i, text(english, n), "en") for i, n in enumerate([14, 16, 300, 900])]
    out = judge(materialize(measure(spark.createDataFrame(rows, "doc_id long, text string, lang string")), "quality"))
    kept = {r.doc_id: r.kept or r.base_failed for r in out.collect()}
    assert all(kept[d] for d in kept if 1000 <= d < 2000 or d >= 3000), [d for d in kept if not kept[d]]


def test_words_with_digits_are_judged(spark):
    rng = random.Random(6)
    english = "plain words of common language that vocabulary knows well enough for this and other texts about them".split()
    text = lambda n: " ".join(rng.choice(english) for _ in range(n))
    code = lambda: f"{rng.getrandbits(160):040x}"
    rows = [(i, f"{text(rng.randrange(40, 60))} {code() if i % 5 == 0 else ''}") for i in range(200)]
    rows += [(1000 + i, " ".join([text(40), *[code() for _ in range(400)]])) for i in range(3)]
    rows += [(2000 + i, " ".join(code() for _ in range(40))) for i in range(3)]
    rows += [(3000 + i, "\n".join(f"2024-{rng.randrange(12)}-{k} {rng.randrange(10**6)}.50 -{k * i},1" for k in range(30)))
             for i in range(3)]
    df = spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, lang string")
    kept = {r.doc_id: r.kept for r in judge(materialize(measure(df), "quality")).where("not base_failed").collect()}
    assert sum(kept[d] for d in range(200)) > 190 and sum(kept[d] for d in range(0, 200, 5)) > 36
    assert not any(kept[d] for d in kept if 1000 <= d < 3000) and all(kept[d] for d in kept if d >= 3000)
    assert len(kept) == 209
