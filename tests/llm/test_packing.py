import zlib

import numpy as np
import pytest

from vigil.llm import vocab
from vigil.llm.packing import CAPACITY, cuts, pack
from vigil.llm.vocab import WordBpe, vocabulary


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary("word_bpe_49k.json"))


def check(rows, ids_of):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for seq in by_seq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= CAPACITY
    for doc, pieces in by_doc.items():
        ids, at = ids_of(doc), 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    sizes = [sum(r.length for r in s) for s in by_seq.values()]
    return sum(CAPACITY - n for n in sizes if n & (n - 1)) / sum(sizes)


def test_each_id_once_and_little_padding(spark, sf, documents, tokenizer):
    rows = pack(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    ids_of = lambda d: np.array(tokenizer.encode(documents[d] or "", add_special_tokens=False).ids + [1], "<u4")
    assert {r.doc_id for r in rows} == set(documents)
    assert check(rows, ids_of) < 0.01


def test_odd_documents(spark, odd_docs, tokenizer):
    rows = pack(odd_docs, with_ids=True).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert [r.length for r in by[4]] == [1] and list(by[4][0].ids) == [1]   # null: the end id
    assert [r.length for r in by[5]] == [1]
    one = len(tokenizer.encode(odd_docs.where("doc_id = 2").first().text, add_special_tokens=False).ids) + 1
    assert sum(r.length for r in by[1]) == 2 * one and sum(r.length for r in by[2]) == one
    assert sum(r.length for r in by[9]) == by[9][0].doc_tokens > 60_000


def test_empty_table(no_docs):
    out = pack(no_docs)
    assert out.count() == 0 and out.columns[:2] == ["doc_id", "start"]


@pytest.mark.parametrize("n", [0, 1, 5, 682, 700, 1000, 1024, 1500, 2047, 2048, 2049, 9000])
def test_cuts_cover_and_fit_their_class(n):
    parts = cuts(n)
    assert sum(x for x, _ in parts) == n
    assert all(x * k <= CAPACITY for x, k in parts)


def test_cached_ids_equal_the_tokenizer(tokenizer, documents):
    odd = ["İstanbul ŉ’n Straße ΣΑΣ don't 'tis <|endoftext|>x a\x1cb\x85c été 123 4½ ſ K 　 日本語 !!'s", "", " \n"]
    texts = odd + [t or "" for t in list(documents.values())[:60]]
    got = WordBpe(vocabulary("word_bpe_49k.json")).encode(texts)
    for t, g in zip(texts, got):
        assert np.frombuffer(g, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_a_worker_holds_the_state_of_one_operator():
    from vigil.llm import common
    from vigil.llm.toxicity import Model, Settings, _worker

    class Shared:
        value = Model(["rotten"], [], [], Settings())

    path = vocab.vocabulary("word_bpe_49k.json")
    bpe = vocab.opened(vocab.WordBpe, path)
    assert vocab.opened(vocab.WordBpe, path) is bpe
    state = _worker(Shared, "a")
    assert _worker(Shared, "a") is state
    assert vocab.opened(vocab.WordBpe, path) is not bpe  # gone when the other operator began
    common.only()
    assert not common._state
