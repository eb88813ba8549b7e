"""Helpers shared by the operators: tables, worker imports, word hashing.

The hashing helpers work on whole Arrow buffers with numpy, so no Python
string is made per word.  A word hash is a polynomial over random 64-bit byte
values; phrases combine word hashes the same way and are mixed at the end.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

CHUNK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Make the package importable in Python workers (once per context)."""
    sc = spark.sparkContext
    if getattr(sc, "_vigil_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="vigil-ship-"), "vigil_package.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(package):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(target)
    sc._vigil_shipped = True


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_state: dict = {}


def only(key=None, make=None):
    """State of one operator in each Python worker, made once.

    All operators of a session share its workers, so what another operator left there (word caches, automata) goes
    first; an operator without state calls it with nothing.
    """
    if key not in _state:
        _state.clear()
        if key is not None:
            _state[key] = make()
    return _state.get(key)


# -- Arrow text ------------------------------------------------------------------------------

def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text has length 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    t = np.zeros(256, bool)
    for lo, hi in ranges:
        t[lo:hi + 1] = True
    return t


#: Separators of the words `[^\x20\x09-\x0D]+`.
SPACE = byte_set((0x20, 0x20), (0x09, 0x0D))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_RNG = np.random.default_rng(0x5EED)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def _pow(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 64)
        p = np.full(size, _P, np.uint64)
        p[0] = 1
        _powers = np.multiply.accumulate(p)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (a bijection), applied to uint64 arrays."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _hash_span(b: np.ndarray, breaks: np.ndarray, sep: np.ndarray, fold: bool):
    """Word hashes, starts and ends of one span of bytes; breaks: forced word starts."""
    if fold:
        b = LOWER[b]
    inside = ~sep[b]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    breaks = breaks[breaks < len(b)]
    first[breaks] = inside[breaks]
    starts = np.flatnonzero(first)
    if not len(starts):
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z
    at = np.flatnonzero(inside)
    where = np.searchsorted(at, starts)
    lengths = np.diff(np.append(where, len(at)))
    pos = np.arange(len(at)) - np.repeat(where, lengths)
    h = np.add.reduceat(_BYTE[b[at]] * _pow(int(lengths.max()))[pos], where)
    return mix(h + lengths.astype(np.uint64)), starts, starts + lengths


def hash_words(data: np.ndarray, offsets: np.ndarray, sep: np.ndarray = SPACE, fold: bool = False):
    """(hashes, first word of each text, word starts, word ends) over all texts.

    Texts are taken in spans of about ``CHUNK_BYTES`` to bound the temporary
    arrays; a longer text is cut between two words.
    """
    hs, ss, es, n = [], [], [], len(data)
    lo = 0
    while lo < n:
        hi = min(n, lo + CHUNK_BYTES)
        if hi < n:
            k = int(np.searchsorted(offsets, hi, side="right")) - 1
            if offsets[k] > lo:
                hi = int(offsets[k])
            else:
                while hi < n:  # inside a long text: up to the next separator, or the end of that text
                    end = min(int(offsets[k + 1]), hi + CHUNK_BYTES)
                    cut = np.flatnonzero(sep[data[hi:end]])
                    if len(cut):
                        hi += int(cut[0])
                        break
                    hi = end
                    if hi == int(offsets[k + 1]):
                        break
        a, z = np.searchsorted(offsets, lo), np.searchsorted(offsets, hi)
        h, s, e = _hash_span(data[lo:hi], offsets[a:z] - lo, sep, fold)
        hs.append(h)
        ss.append(s + lo)
        es.append(e + lo)
        lo = hi
    cat = lambda xs, t: np.concatenate(xs) if xs else np.zeros(0, t)
    hashes, starts, ends = cat(hs, np.uint64), cat(ss, np.int64), cat(es, np.int64)
    return hashes, np.searchsorted(starts, offsets), starts, ends


def phrase_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive word hashes (len(h) - k + 1 values)."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    # doubling: acc covers `have` words, square covers `step` words
    acc, have, square, step, left = None, 0, h, 1, k
    while left:
        if left & 1:
            n = len(h) - (have + step) + 1
            if acc is None:
                acc = square[:n]
            else:
                acc = mix(acc[:n] * _P + square[have:have + n])
            have += step
        left >>= 1
        if left:
            n = len(square) - step
            square, step = mix(square[:n] * _P + square[step:step + n]), step * 2
    return mix(acc + np.uint64(k))


def batches_of(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each (one row at least)."""
    _, offsets = text_buffers(batch.column(batch.schema.get_field_index(column)))
    lo, n = 0, batch.num_rows
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


# -- packed counts, keyed by ranges of hashes ----------------------------------------------------

_langs: dict[str, int] = {}


def lang_keys(langs: list[str]) -> np.ndarray:
    """64-bit keys of language names."""
    for x in langs:
        if x not in _langs:
            _langs[x] = int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little")
    return np.array([_langs[x] for x in langs], np.uint64)


def owners(key: np.ndarray, parts: int) -> np.ndarray:
    """Number of the range of hashes that holds each key; ranges follow the order of keys."""
    return ((key >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of the slices one after another, offset of each slice and the end)."""
    size = ends - starts
    cuts = np.concatenate([[0], np.cumsum(size)])
    return data[np.arange(cuts[-1]) + np.repeat(starts - cuts[:-1], size)], cuts


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of all texts of a column, for the number of parts of the work."""
    return docs.selectExpr(f"sum(cast(octet_length(cast(`{column}` as string)) as long)) n").first()["n"] or 0
