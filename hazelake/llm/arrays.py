"""Column arrays of text for the operators that run numpy inside Spark tasks.

A chunk is the UTF-8 bytes of several documents laid end to end (``data``) with the document
offsets (``offs``). Substring hashes come from prefix polynomial hashes modulo 2**64: with
``P[i+1] = P[i] + v[i] * B**i`` the hash of ``[i, j)`` is ``(P[j] - P[i]) * B**-i``, so any
substring costs two lookups. The values ``v`` are random odd 64-bit numbers per byte.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from hazelake.session import ship_package

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 5  # odd, so it has an inverse modulo 2**64
CHUNK_BYTES = 2 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
ALNUM = np.zeros(256, bool)  # after lower-casing: digits, a-z and every byte of a non-ASCII character
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def mix(x):
    """Bijective 64-bit finaliser: spreads a polynomial hash over all bits."""
    x = np.asarray(x, U64)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(0xA0761D6478BD642F)) | U64(1)

_POW = np.ones(1, U64)
_INV = np.ones(1, U64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``B**i`` and ``B**-i`` for i below n (kept per process, grown by doubling)."""
    global _POW, _INV
    if len(_POW) < n:
        size = max(n, 2 * len(_POW))
        out = []
        for b in (BASE, pow(BASE, -1, 1 << 64)):
            a = np.full(size, b, U64)
            a[0] = 1
            out.append(np.multiply.accumulate(a))
        _POW, _INV = out
    return _POW[:n], _INV[:n]


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """P of the module text, one longer than ``values``."""
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values * powers(len(values) + 1)[0][:-1], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every [start, end)."""
    return mix((prefix[ends] - prefix[starts]) * powers(len(prefix))[1][starts])


_PLACED = mix(np.arange(64 * 256, dtype=U64) * U64(0xE7037ED1A0B428DB) + U64(1))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each (non-empty) word: the sum of its bytes, each mixed with its place in the word. Other than a
    polynomial modulo 2**64, whose hashes of long words of two symbols collide by their form alone."""
    if not len(starts):
        return np.zeros(0, U64)
    lens = ends - starts
    first = np.cumsum(lens) - lens
    key = (np.arange(int(lens.sum())) - np.repeat(first, lens)) << 8 | data[ranges(starts, lens)]
    value = _PLACED[np.minimum(key, len(_PLACED) - 1)]
    far = np.flatnonzero(key >= len(_PLACED))
    value[far] = mix(key[far].astype(U64) * U64(0xE7037ED1A0B428DB) + U64(1))
    return mix(np.add.reduceat(value, first) + lens.astype(U64) * U64(0x8EBC6AF09C88C6E3))


def spans(mask: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``mask`` that do not cross a document offset."""
    n = len(mask)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    start = mask.copy()
    start[1:] &= ~mask[:-1] | edge[1:n]
    end = mask.copy()
    end[:-1] &= ~mask[1:] | edge[1:n]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def owners(offs: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Index of the document that holds each position."""
    return np.searchsorted(offs, starts, side="right") - 1


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i]+1, ...`` (``lengths[i]`` numbers each), end to end."""
    starts, lengths = np.asarray(starts, np.int64), np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)


def slices(batches, column: str, max_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that one holds at most ``max_bytes`` of ``column`` (a single longer
    row stays whole)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(col), 0), np.int64))
        lo = 0
        while lo < batch.num_rows:
            base = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(data, offs) of a string or binary column; null is empty."""
    if col.null_count:
        col = pc.fill_null(col, b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], np.int64 if wide else np.int32, len(col) + 1, col.offset * (8 if wide else 4)).astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def unused(taken: list[str], *names: str) -> list[str]:
    """``names``, made different from all of ``taken`` (Spark compares without regard to case)."""
    held = {t.lower() for t in taken}
    out = []
    for name in names:
        while name.lower() in held:
            name += "_"
        held.add(name.lower())
        out.append(name)
    return out


def column(batch: pa.RecordBatch, name: str):
    return batch.column(batch.schema.get_field_index(name))


def prepare(spark: SparkSession) -> None:
    """Ship the package to the workers, and bound the Arrow batches by bytes and rows, so that long
    documents cannot fill a worker."""
    ship_package(spark)
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", "2000"),
                       ("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))):
        spark.conf.set(key, value)


def released() -> None:
    """Give the memory that a partition has freed back to the system: a reused worker would keep it
    beside the next stages' tasks."""
    global _POW, _INV
    _POW = _INV = np.ones(1, U64)
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def lean(run):
    """``run`` for mapInArrow, with ``released`` at the end of its partition."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            released()
    return wrapped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(col: str, modulus: int):
    """crc32 of the id as text modulo ``modulus``; a null id gives null."""
    from pyspark.sql import functions as F
    return F.crc32(F.col(col).cast("string").cast("binary")) % modulus
