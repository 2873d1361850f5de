"""A pair of Bloom filters for hashes seen once and hashes seen at least twice.

``SeenTwice`` is mergeable: the union of two parts marks as seen twice what
either part saw twice or both parts saw.  Parts travel as compressed slices,
so the merge is a distributed reduce by slice and the driver only joins the
merged slices of the "twice" filter.  ``bits_for`` sizes a filter by a count of
what goes in, up to ``MOST_BITS``, which is what a task can hold twice and a
broadcast once; beyond ``MOST_BITS / BITS_A_HASH`` hashes it fills up.  A fuller
filter lets more hashes through; the exact step behind it decides, so results
never depend on its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Probes of a hash, taken from separate bits of a 64-bit hash re-mixed once.
PROBES = 3
SLICE_BITS = 1 << 20
BITS_A_HASH = 8
LEAST_BITS, MOST_BITS = 1 << 22, 1 << 29
#: Map tasks' slices that one merging task takes; more are merged in two steps.
MERGED_AT_ONCE = 1024


def bits_for(hashes: int) -> int:
    """Bits of a filter that so many hashes go into: a power of two, ``BITS_A_HASH`` a hash at least where that is allowed."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << max(0, hashes * BITS_A_HASH - 1).bit_length()))


def _mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that probe positions do not share the hash's own structure."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


def positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """PROBES bit positions per hash, as an array (PROBES, n)."""
    mask = np.uint64(bits - 1)
    a, b = hashes & mask, _mix(hashes)
    step = (b >> np.uint64(20)) | np.uint64(1)
    return np.stack([(a + np.uint64(i) * step + b) & mask for i in range(PROBES)]).astype(np.int64)


def probe(filter_bytes: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    """Whether each hash may be in the filter."""
    hit = np.ones(len(hashes), bool)
    for at in positions(hashes, bits):
        hit &= (filter_bytes[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return hit


class SeenTwice:
    """Once-seen and twice-seen filters of one task."""

    def __init__(self, bits: int):
        self.bits = bits
        self.once = np.zeros(bits // 8, np.uint8)
        self.twice = np.zeros(bits // 8, np.uint8)

    @staticmethod
    def _set(bitmap: np.ndarray, at: np.ndarray) -> None:
        np.bitwise_or.at(bitmap, at >> 3, (1 << (at & 7)).astype(np.uint8))

    def add(self, hashes: np.ndarray) -> None:
        """Count each element of ``hashes`` as one sighting."""
        distinct, times = np.unique(hashes, return_counts=True)
        again = (times > 1) | probe(self.once, distinct, self.bits)
        for at in positions(distinct[again], self.bits):
            self._set(self.twice, at)
        for at in positions(distinct, self.bits):
            self._set(self.once, at)

    def slices(self):
        """(slice number, once, twice) of every slice with a bit set, compressed."""
        step = SLICE_BITS // 8
        pack = zstandard.ZstdCompressor(level=1)
        for k in range(0, len(self.once), step):
            once = self.once[k : k + step]
            if once.any():
                yield k // step, pack.compress(once.tobytes()), pack.compress(self.twice[k : k + step].tobytes())


SLICES = "slice int, once binary, twice binary"


def slice_batch(seen: SeenTwice) -> pa.RecordBatch:
    rows = list(seen.slices())
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2))],
        names=["slice", "once", "twice"],
    )


def _united(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    once = twice = None
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        for o, t in zip(batch.column("once").to_pylist(), batch.column("twice").to_pylist()):
            o, t = (np.frombuffer(unpack.decompress(x), np.uint8) for x in (o, t))
            if once is None:
                once, twice = o.copy(), t.copy()
            else:
                twice |= t | (once & o)
                once |= o
    return once, twice


def _merge_some(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    merged = [pa.array([pack.compress(x.tobytes())], pa.binary()) for x in _united(batches)]
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), *merged], names=["slice", "once", "twice"])


def _merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packed = zstandard.ZstdCompressor(level=1).compress(_united(batches)[1].tobytes())
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([packed], pa.binary())], names=["slice", "twice"])


def merged_twice(parts: DataFrame, bits: int) -> np.ndarray:
    """The whole input's twice-seen filter, ``bits`` / 8 bytes, from the tasks' slices."""
    groups = -(-parts.rdd.getNumPartitions() // MERGED_AT_ONCE)
    if groups > 1:
        dealt = parts.withColumn("g", F.pmod(F.spark_partition_id(), F.lit(groups)))
        parts = dealt.groupBy("slice", "g").applyInArrow(_merge_some, SLICES)
    merged = parts.groupBy("slice").applyInArrow(_merge, "slice int, twice binary")
    out = np.zeros(bits // 8, np.uint8)
    unpack = zstandard.ZstdDecompressor()
    step = SLICE_BITS // 8
    for row in merged.collect():  # at most bits / SLICE_BITS rows
        out[row["slice"] * step : (row["slice"] + 1) * step] = np.frombuffer(unpack.decompress(bytes(row["twice"])), np.uint8)
    return out
