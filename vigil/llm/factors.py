"""Substring dedup by hashed windows, in place of a relative Lempel-Ziv parse.

No document is parsed greedily: every phrase of ``n`` words near a shared anchor
is looked up by hash.  A factor here is a run of words that occurs earlier (in a document with a smaller id, or earlier in the same one);
a factor of at least ``n`` words is a duplicate span, and its words are removed.

The reference text is indexed in blocks, spread over tasks by hash:

1. every block of documents puts its anchors into the index, which are the
   smallest-hashed 6-word phrases of each n-word window; equal windows choose
   equal anchors, so a factor can only start where an anchor occurs elsewhere,
2. documents with shared anchors put the n-word phrases around them into the
   index, which tells for each phrase whether an earlier one is the source,
3. consecutive phrases with earlier sources form the factors; as each
   phrase is looked up by itself, the first and last words of a factor are
   checked exactly and factors may change their source on the way.

A block sends a phrase once, however often it holds it: later occurrences in
the block are known to have an earlier source.  A phrase that a third of all
documents hold thus costs its index task one entry for each block.

Phrases are compared by 64-bit hashes of their words (unchanged, not folded).

Defined results: documents are ordered by id (null first) and the hash of
their text; repeated rows of one id and text are one document and get equal
results; null and empty texts have no words; an empty table gives no rows;
texts of any length are whole; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import batches_of, hash_words, mix, phrase_hashes, ship, shuffle_partitions, text_buffers
from vigil.session import materialize

ANCHOR = 6
WORD = re.compile(r"[^\x20\x09-\x0D]+")
_NULL_ID = -(1 << 63)


def windows(column, n: int):
    """Of all n-word windows inside one text: (document, start, phrase hash, anchor); then the hashes of all
    anchor-sized phrases and each document's first word.  Anchors are word numbers over all texts."""
    data, offsets = text_buffers(column)
    h, first, _, _ = hash_words(data, offsets)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    if len(h) < n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64), z, np.zeros(0, np.uint64), first
    g = phrase_hashes(h, ANCHOR)
    # sliding smallest anchor: positions of the smallest of n - ANCHOR + 1 phrases, by doubling
    at, have = np.arange(len(g)), 1
    need = n - ANCHOR + 1
    while have < need:
        step = min(have, need - have)
        a, b = at[:len(at) - step], at[step:]
        at = np.where(g[a] <= g[b], a, b)
        have += step
    inside = np.flatnonzero(doc[:len(h) - n + 1] == doc[n - 1:])
    return doc[inside], inside - first[doc[inside]], phrase_hashes(h, n)[inside], at[inside], g, first


def _blob(hashes: np.ndarray, owner: np.ndarray, pos: np.ndarray) -> bytes:
    return hashes.tobytes() + owner.astype("<u4").tobytes() + pos.astype("<u4").tobytes()


def _entries(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    k = len(raw) // 16
    return np.frombuffer(raw, "<u8", k), np.frombuffer(raw, "<u4", k, 8 * k), np.frombuffer(raw, "<u4", k, 12 * k)


#: Entries (hash, owner, position) with their owners' ids; kind 0 asks index part ``part``, kind 1 answers the
#: owners, who are dealt over as many parts.  Rows hold the entries of many documents, so their number doesn't grow
#: with documents times parts.
SENT = "kind int, part int, payload binary, ids array<long>, texts array<long>"
_SENT = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("payload", pa.binary()), ("ids", pa.list_(pa.int64())),
                   ("texts", pa.list_(pa.int64()))])
FOUND = "doc_id long, text_hash long, starts array<int>"
_FOUND = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("starts", pa.list_(pa.int32()))])


def _in_order(part: pa.RecordBatch) -> pa.RecordBatch:
    """Rows in document order, one for each document."""
    did = part.column(0).fill_null(_NULL_ID).to_numpy(zero_copy_only=False)
    th = part.column(1).to_numpy(zero_copy_only=False)
    order = np.lexsort((th, did))
    did, th = did[order], th[order]
    new = np.ones(len(order), bool)
    new[1:] = (did[1:] != did[:-1]) | (th[1:] != th[:-1])
    order = order[new]
    return part if len(order) == part.num_rows and (np.diff(order) == 1).all() else part.take(pa.array(order))


def _rows(kind: int, part: np.ndarray, hashes: np.ndarray, owner: np.ndarray, pos: np.ndarray, ids: np.ndarray,
          texts: np.ndarray) -> list[tuple]:
    """One row for each value of ``part``; ids and texts are by owner."""
    by = np.argsort(part, kind="stable")
    numbers, edges = np.unique(part[by], return_index=True)
    rows = []
    for p, at in zip(numbers.tolist(), np.split(by, edges[1:])):
        docs, local = np.unique(owner[at], return_inverse=True)
        rows.append((kind, p, _blob(hashes[at], local, pos[at]), ids[docs], texts[docs]))
    return rows


def _answers(owner: np.ndarray, pos: np.ndarray, ids: np.ndarray, texts: np.ndarray, parts: int) -> list[tuple]:
    home = (mix(ids.view(np.uint64) ^ mix(texts.view(np.uint64))) % np.uint64(parts)).astype(np.int64)
    return _rows(1, home[owner], np.zeros(len(owner), np.uint64), owner, pos, ids, texts)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t.type) for i, t in enumerate(_SENT)], schema=_SENT)


def _send(part: pa.RecordBatch, hashes: np.ndarray, owner: np.ndarray, pos: np.ndarray, parts: int) -> pa.RecordBatch:
    """First occurrences to their index parts; the owners of later ones in this block have their answer.

    Entries come in document order.  A locally repeated phrase is sent with its first occurrence only.
    """
    order = np.argsort(hashes, kind="stable")
    s = hashes[order]
    later = np.zeros(len(s), bool)
    later[1:] = s[1:] == s[:-1]
    first, again = np.sort(order[~later]), np.sort(order[later])
    ids = part.column(0).fill_null(_NULL_ID).to_numpy(zero_copy_only=False)
    texts = part.column(1).to_numpy(zero_copy_only=False)
    dealt = ((hashes[first] >> np.uint64(17)) % np.uint64(parts)).astype(np.int64)
    return _batch(_rows(0, dealt, hashes[first], owner[first], pos[first], ids, texts)
                  + _answers(owner[again], pos[again], ids, texts, parts))


def _told(ids: np.ndarray, texts: np.ndarray, owner: np.ndarray, pos: np.ndarray) -> pa.Table:
    """Positions by owner."""
    order = np.lexsort((pos, owner))
    owner, pos = owner[order], pos[order]
    docs, at = np.unique(owner, return_index=True)
    lists = pa.ListArray.from_arrays(pa.array(np.append(at, len(pos)), pa.int32()), pa.array(pos.astype(np.int32)))
    did = pa.array(ids[docs], pa.int64(), mask=ids[docs] == _NULL_ID)
    return pa.Table.from_arrays([did, pa.array(texts[docs], pa.int64()), lists], schema=_FOUND)


def _gathered(t: pa.Table):
    """Entries of all blobs of an index part with owners numbered in document order."""
    ids = t.column("ids").combine_chunks()
    texts = t.column("texts").combine_chunks()
    did, th = ids.flatten().to_numpy(zero_copy_only=False), texts.flatten().to_numpy(zero_copy_only=False)
    sizes = ids.value_lengths().to_numpy(zero_copy_only=False)
    order = np.lexsort((th, did))
    d, x = did[order], th[order]
    new = np.ones(len(order), bool)
    new[1:] = (d[1:] != d[:-1]) | (x[1:] != x[:-1])
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new) - 1
    base = np.cumsum(sizes) - sizes
    hs, os_, ps = [], [], []
    for b, raw in enumerate(t.column("payload").to_pylist()):
        h, o, p = _entries(raw)
        hs.append(h)
        os_.append(rank[base[b] + o])
        ps.append(p)
    cat = np.concatenate
    return cat(hs), cat(os_), cat(ps), d[new], x[new]


def _index(sent: DataFrame, anchors: bool, parts: int) -> DataFrame:
    """By document: positions of anchors that occur in several places, or of phrases with an earlier source."""
    def ask(key, t):
        t = t.combine_chunks()
        if key[0].as_py():  # an answer already
            return t
        h, owner, pos, ids, texts = _gathered(t)
        order = np.lexsort((pos, owner, h))
        s = h[order]
        start = np.ones(len(s), bool)
        start[1:] = s[1:] != s[:-1]
        group = np.cumsum(start) - 1
        if anchors:
            hit = np.bincount(group)[group] > 1
        else:
            lead = order[start][group]  # the earliest occurrence; repeated rows of a document are the same one
            hit = (owner[order] != owner[lead]) | (pos[order] != pos[lead])
        told = np.sort(order[hit])
        return pa.Table.from_batches([_batch(_answers(owner[told], pos[told], ids, texts, parts))], schema=_SENT)

    def tell(key, t):
        h, owner, pos, ids, texts = _gathered(t.combine_chunks())
        return _told(ids, texts, owner, pos)

    return sent.groupBy("kind", "part").applyInArrow(ask, SENT).groupBy("part").applyInArrow(tell, FOUND)


def factor_spans(docs: DataFrame, n: int = 20) -> DataFrame:
    """doc_id, text_hash, text, starts: the starts of n-word windows with an earlier source (null: none)."""
    spark = docs.sparkSession
    ship(spark)
    parts = shuffle_partitions(spark)
    d = docs.selectExpr("cast(doc_id as long) doc_id", "coalesce(xxhash64(cast(text as string)), 0L) text_hash",
                        "cast(text as string) text")

    def anchors(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for part in batches_of(batch, "text"):
                part = _in_order(part)
                doc, _, _, at, g, first = windows(part.column(2), n)
                if len(doc):
                    new = np.ones(len(at), bool)
                    new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
                    at, doc = at[new], doc[new]
                    yield _send_anchors(part, g[at], doc, at - first[doc], parts)

    def phrases(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for part in batches_of(batch, "text"):
                part = _in_order(part)
                doc, start, h, at, _, first = windows(part.column(2), n)
                if not len(doc):
                    continue
                flagged = np.zeros(int(first[-1]) + 1, bool)
                shared = part.column(3)
                lists = shared.flatten().to_numpy(zero_copy_only=False)
                flagged[np.repeat(first[:-1], shared.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)) + lists] = True
                use = flagged[at]
                if use.any():
                    yield _send(part, h[use], doc[use], start[use], parts)

    shared = materialize(_index(d.mapInArrow(anchors, SENT), True, parts), "anchors").withColumnsRenamed(
        {"doc_id": "d", "text_hash": "t"})
    on = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t"))
    some = d.join(shared, on).select("doc_id", "text_hash", "text", "starts")
    found = materialize(_index(some.mapInArrow(phrases, SENT), False, parts), "factors").withColumnsRenamed(
        {"doc_id": "d", "text_hash": "t"})
    return d.join(found, on, "left").select("doc_id", "text_hash", "text", "starts")


def _send_anchors(part, hashes, owner, pos, parts):
    """As _send, with the first of locally repeated anchors told to be shared as well."""
    order = np.argsort(hashes, kind="stable")
    s = hashes[order]
    twin = np.zeros(len(s), bool)
    twin[1:] = s[1:] == s[:-1]
    lead = np.zeros(len(s), bool)
    lead[:-1] = twin[1:] & ~twin[:-1]
    extra = order[lead]
    # appended copies sort after the originals, so they become "later" entries of the block
    both = np.concatenate([np.arange(len(hashes)), extra])
    return _send(part, hashes[both], owner[both], pos[both], parts)


def remove_repeats(docs: DataFrame, n: int = 20) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (kept words joined by one blank), spans of removed words."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for part in batches_of(batch, "text"):
                rows = []
                for doc, text, starts in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2)):
                    ws = WORD.findall(text or "")
                    if not starts.is_valid:
                        rows.append((doc, len(ws), 0, " ".join(ws), []))
                        continue
                    at = np.unique(starts.values.to_numpy())
                    edge = np.zeros(len(ws) + 1, np.int64)
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + n, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    turn = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
                    rows.append((doc, len(ws), int(gone.sum()), " ".join([w for w, x in zip(ws, gone.tolist()) if not x]),
                                 [{"start": int(a), "end": int(z)} for a, z in turn.reshape(-1, 2)]))
                types = (pa.int64(), pa.int64(), pa.int64(), pa.string(),
                         pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                                 names=["doc_id", "n_words", "n_removed", "kept_text", "spans"])

    return factor_spans(docs, n).select("doc_id", "text", "starts").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_text string, spans array<struct<start:int,end:int>>")
