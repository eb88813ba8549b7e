import random

import numpy as np
import pytest

from vigil.llm.resync import ByteBpe, places, token_counts
from vigil.llm.vocab import vocabulary

ATOMS = ["a", "Z", "é", "字", "。", " ", "  ", "\n", "\t", "'s", "'ll", "'", "1", "23", "<|endoftext|>", "<|", "|>", "!", ",",
         ".", "\xa0", "　", "🙂", "the", "ing", "\x1c", "½", "x" * 40, "\x00"]


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    return lambda t: len(tok.encode(t or "", add_special_tokens=False))


def texts():
    rng = random.Random(1)
    return (["".join(rng.choice(ATOMS) for _ in range(rng.randrange(900))) for _ in range(120)]
            + ["x" * 3000, "字" * 2000, "1" * 2000, "", " " * 2000, "\n" * 2000, "<|endoftext|>" * 200, "a1" * 1000, None])


@pytest.mark.parametrize("chunk, overlap", [(300, 20), (64, 8)])
def test_any_cut_equals_the_whole(spark, whole, chunk, overlap):
    docs = texts()
    got = token_counts(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), chunk=chunk, overlap=overlap)
    assert {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got.collect()} == {
        (i, len((t or "").encode()), whole(t), whole(t) > 1024) for i, t in enumerate(docs)}


def test_words_equal_the_whole(whole):
    bpe = ByteBpe(vocabulary("byte_bpe_50k.json"))
    docs = [t or "" for t in texts()]
    assert bpe.counts(docs) == [whole(t) for t in docs]
    bpe.counts(["one two"])
    bpe.known.update((f" {i}", 1) for i in range(600_000))  # overfull: the older half is kept aside
    assert bpe.counts(["one two", "two  one\n\nthree "]) == [whole("one two"), whole("two  one\n\nthree ")]


def test_places_are_token_ends():
    bpe = ByteBpe(vocabulary("byte_bpe_50k.json"))
    text = "Hello world 42nd street, it's <|endoftext|> fine"
    at, before = places(text, bpe.ends(text), 0, len(text), True)
    assert text[:at[0]] == "Hello" and before[0] == 1 and at[-1] == len(text)
    assert np.all(np.diff(at) > 0) and "<|endo" not in [text[a - 6:a] for a in at.tolist()]


def test_odd_rows(spark, odd_docs, no_docs, whole):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in token_counts(odd_docs, chunk=5000).collect())
    assert got == sorted((r.doc_id is None, r.doc_id or 0, whole(r.text)) for r in odd_docs.collect())
    assert token_counts(no_docs).collect() == []
