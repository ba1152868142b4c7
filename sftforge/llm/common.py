"""Shared helpers: Arrow text buffers, vectorised words and substring hashes.

Tasks receive texts as Arrow batches; the helpers work on the UTF-8 bytes of a
batch as one numpy array, in slices of a few megabytes, so a worker's memory is
bounded by the slice (or by one text, if that alone is longer).
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

from sftforge.session import materialize, ship_package

__all__ = ["WORD_BREAK", "PrefixHash", "LOWER", "digests", "documents", "fresh", "lowered", "materialize", "mix",
           "prepare", "release", "sliced", "spread", "text_bytes", "words"]

SLICE_BYTES = 2 << 20

#: Word separators of the contracts: blank and the ASCII controls tab to carriage return.
WORD_BREAK = np.zeros(256, bool)
WORD_BREAK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Byte map that lower-cases A-Z and leaves every other byte alone.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_U = np.uint64


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def prepare(spark: SparkSession) -> None:
    """Make the package importable in Python workers of any cluster."""
    ship_package(spark)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts back to back, and the offsets of each (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def sliced(batches: Iterator[pa.RecordBatch], text: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds at most ``limit`` text bytes, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size)
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def code_points(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The code points (uint32) of all texts back to back, and the offsets of each (null: empty)."""
    data, offsets = text_bytes(column)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    upto = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return points, upto[offsets]


def words(data: np.ndarray, offsets: np.ndarray,
          breaks: np.ndarray = WORD_BREAK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (exclusive) and row of every maximal run of non-break bytes; runs end with their row."""
    inside = ~breaks[data]
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, rows


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = np.asarray(x, _U).copy()
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next slice of a worker."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.empty(size, _U)
        have[0] = 1
        filled = 1
        while filled < size:
            step = min(filled, size - filled)
            have[filled:filled + step] = have[:step] * _U(pow(base, filled, 1 << 64))
            filled += step
        _POWERS[base] = have
    return have[:n]


def digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """XXH3 (64 bits) of the bytes of each substring."""
    size, digest = data.itemsize, xxhash.xxh3_64_intdigest
    view = memoryview(np.ascontiguousarray(data).view(np.uint8))
    return np.fromiter((digest(view[s:e]) for s, e in zip((starts * size).tolist(), (ends * size).tolist())), _U, len(starts))


class PrefixHash:
    """64-bit hashes of any substrings of one array of bytes or code points, each in constant time.

    A polynomial over random values modulo 2**64, mixed at the end.  Equal
    strings hash alike wherever they stand, in every task and run.  Modulo a power
    of two a polynomial sends some unequal strings to one value whatever its base,
    the more the longer they are (the Thue-Morse word and its complement, say), so
    ``of`` takes XXH3 of the bytes themselves from ``LONG`` units on.  ``raw`` is
    the bare polynomial: for short windows, and for candidates that are verified.
    """

    LONG = 48

    _VALUES = mix(np.arange(256, dtype=_U) * _U(0xD6E8FEB86659FD93) + _U(0x1234567))

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.data = data
        values = self._VALUES[data] if data.dtype == np.uint8 else mix(data.astype(_U) + _U(0x51ED27))
        self.sums = np.zeros(n + 1, _U)
        np.cumsum(values * _powers(_BASE, n), out=self.sums[1:])
        self.inverse = _powers(_INVERSE, n + 1)

    def raw(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.inverse[starts]

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = mix(self.raw(starts, ends) + (ends - starts).astype(_U) * _U(0xA0761D6478BD642F))
        long = np.flatnonzero(ends - starts >= self.LONG)
        if len(long):
            out[long] = digests(self.data, starts[long], ends[long])
        return out


def fresh(taken, name: str) -> str:
    """``name``, lengthened until it is none of the columns ``taken`` (whatever their letters' case)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def release() -> None:
    """Hand freed memory back to the system, where the C library can."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def lowered(data: np.ndarray) -> np.ndarray:
    return LOWER[data]


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of the given sizes laid end to end: the group of each element, its place in the group."""
    group = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return group, np.arange(len(group)) - first[group]
