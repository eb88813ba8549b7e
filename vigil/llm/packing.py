"""Harmonic packing of tokenised documents into sequences of fixed length.

A document's ids (and one end id) are cut into whole sequences and a rest.  A
rest of length l belongs to the class k with capacity/(k+1) < l <= capacity/k;
each class fills its own open sequence with exactly k pieces.  A rest that
would waste more than ``tolerance`` of its slot is first cut at the slot
length of the next class.  Every Spark task packs its own rows and needs no
other task: no shuffle, and memory for one open sequence of each class.  At
the end of a task the open sequences are cut together into full sequences, and
the last ids into sequences whose lengths are powers of two, which need no
padding.

Defined results: a null or empty text is the end id alone; repeated rows (also
of one doc_id) are packed each; an empty table gives no pieces; a text of any
length is cut whole; extra columns are not read.  ``sequence_id`` is the
partition number times 2**33 plus a counter, so a task that is run again
writes the same ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from vigil.llm.common import batches_of, ship
from vigil.llm.vocab import WordBpe, opened, vocabulary

CAPACITY = 2048
TOLERANCE = 1 / 64
#: Rests up to capacity/16 are never cut: their slots waste little in all.
UNCUT = 16

COLUMNS = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
           "offset long")


def cuts(n: int, capacity: int = CAPACITY, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """(length, class) of the pieces of a document of n ids, in order."""
    out = [(capacity, 1)] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // rest
        slot = capacity // k
        if slot - rest <= tolerance * slot or k >= UNCUT:
            out.append((rest, k))
            break
        piece = capacity // (k + 1)
        out.append((piece, k + 1))
        rest -= piece
    return out


@dataclass
class Packer:
    """Open sequences of one task."""

    base: int
    capacity: int = CAPACITY
    tolerance: float = TOLERANCE
    open: dict[int, list[tuple]] = field(default_factory=dict)
    made: int = 0

    def _close(self, pieces: list[tuple]) -> list[tuple]:
        seq, offset, out = self.base + self.made, 0, []
        self.made += 1
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            out.append((doc, start, n, zlib.crc32(ids), total, seq, offset, ids))
            offset += n
        return out

    def add(self, doc, ids: bytes) -> list[tuple]:
        out, start, total = [], 0, len(ids) // 4
        for n, k in cuts(total, self.capacity, self.tolerance):
            piece = (doc, start, ids[4 * start:4 * (start + n)], total)
            start += n
            bin_ = self.open.setdefault(k, [])
            bin_.append(piece)
            if len(bin_) == k:
                out += self._close(bin_)
                self.open[k] = []
        return out

    def finish(self) -> list[tuple]:
        left = [p for k in sorted(self.open) for p in self.open[k]]
        self.open, out, room, seq = {}, [], 0, []
        n = sum(len(p[2]) // 4 for p in left)
        for doc, start, ids, total in left:
            while ids:
                if not room:
                    room = self.capacity if n >= self.capacity else 1 << (n.bit_length() - 1)
                take = min(room, len(ids) // 4)
                seq.append((doc, start, ids[:4 * take], total))
                ids, start, room, n = ids[4 * take:], start + take, room - take, n - take
                if not room:
                    out += self._close(seq)
                    seq = []
        return out


def pack(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 1, capacity: int = CAPACITY,
         tolerance: float = TOLERANCE, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents (``doc_id``, ``text``), each with its sequence and offset.

    ``with_ids`` adds the piece's ids as ``ids array<int>``.
    """
    ship(docs.sparkSession)
    path = vocabulary(tokenizer)
    schema = pa.schema([(c.split()[0], pa.int64()) for c in COLUMNS.split(", ")])
    if with_ids:
        schema = schema.append(pa.field("ids", pa.list_(pa.int32())))
    end = int(end_id).to_bytes(4, "little")

    def rows_out(rows: list[tuple]) -> pa.RecordBatch:
        import numpy as np

        cols = [pa.array([r[i] for r in rows], pa.int64()) for i in range(7)]
        if with_ids:
            cols.append(pa.array([np.frombuffer(r[7], "<i4") for r in rows], pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(cols, schema=schema)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = opened(WordBpe, path)
        packer = Packer(TaskContext.get().partitionId() << 33, capacity, tolerance)
        for batch in it:
            for part in batches_of(batch, "text"):
                texts = [t or "" for t in part.column(1).to_pylist()]
                rows = []
                for doc, ids in zip(part.column(0).to_pylist(), bpe.encode(texts)):
                    rows += packer.add(doc, ids + end)
                if rows:
                    yield rows_out(rows)
        rows = packer.finish()
        if rows:
            yield rows_out(rows)

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(
        run, COLUMNS + (", ids array<int>" if with_ids else ""))
