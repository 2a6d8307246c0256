"""Two Bloom filters, of hashes seen once and seen twice, merged over tasks into one filter of suspected repeats.

Each task sets, for every hash, its bits in the first filter, and in the second those that were set before. Two
such pairs merge into one: bits of both first filters also enter the second. So every hash that was given twice,
anywhere, has all its bits in the merged second filter; a hash given once seldom has.

The filter has ``BITS_PER_ITEM`` bits an item up to ``MAX_BITS`` (32 MB), the bound of what is broadcast. Beyond
that false suspicions rise; as suspects are confirmed exactly, results stay the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import parallelism, parts_of

BITS_PER_ITEM = 12
MIN_BITS, MAX_BITS = 16, 28  # as powers of two
SEGMENT = 1 << 14  # bytes
_ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9]
_STATE = "segment int, once binary, twice binary"


def bits_for(items: int) -> int:
    return min(max((max(items, 1) * BITS_PER_ITEM - 1).bit_length(), MIN_BITS), MAX_BITS)


def positions(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    for odd in _ODD:
        mixed = hashes * np.uint64(odd)
        yield ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(_ODD[0])) >> np.uint64(64 - bits)


def suspected(hashes: np.ndarray, twice: np.ndarray, bits: int) -> np.ndarray:
    """Whether each hash has all its bits in the second filter."""
    out = np.ones(len(hashes), bool)
    for at in positions(hashes, bits):
        out &= (twice[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return out


class Pair:
    """The two filters of one task."""

    def __init__(self, bits: int) -> None:
        self.bits = bits
        self.once = np.zeros(1 << (bits - 3), np.uint8)
        self.twice = np.zeros(1 << (bits - 3), np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        values, counts = np.unique(hashes, return_counts=True)
        for at in positions(values, self.bits):
            order = np.argsort(at, kind="stable")
            at, n = at[order], counts[order]
            first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.zeros(0, int)
            if not len(first):
                continue
            n, at = np.add.reduceat(n, first), at[first]
            byte, bit = (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)
            again = ((self.once[byte] & bit) != 0) | (n > 1)
            np.bitwise_or.at(self.twice, byte[again], bit[again])
            np.bitwise_or.at(self.once, byte, bit)

    def rows(self) -> Iterator[pa.RecordBatch]:
        for s in range(0, len(self.once), SEGMENT):
            one, two = self.once[s:s + SEGMENT], self.twice[s:s + SEGMENT]
            if one.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s // SEGMENT], pa.int32()), pa.array([one.tobytes()]), pa.array([two.tobytes()])],
                    names=["segment", "once", "twice"],
                )


def _merge(group: pa.Table) -> pa.Table:
    once = twice = None
    for a, b in zip(group["once"].to_pylist(), group["twice"].to_pylist(), strict=True):
        a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
        once, twice = (a, b) if once is None else (once | a, twice | b | (once & a))
    return pa.table({"segment": group["segment"].slice(0, 1), "twice": pa.array([twice.tobytes()])})


def states_of(
    batches: Iterator[pa.RecordBatch], column: str, hashes_of: Callable[[pa.RecordBatch], np.ndarray], bits: int
) -> Iterator[pa.RecordBatch]:
    """The two filters of one task; hashes are made for a part of a batch at a time."""
    pair = Pair(bits)
    for part in parts_of(batches, column):
        pair.add(hashes_of(part))
    yield from pair.rows()


def twice_filter(df: DataFrame, hashes_of: Callable[[pa.RecordBatch], np.ndarray], bits: int) -> Broadcast:
    """The merged second filter over ``hashes_of`` every part of ``df``, a column of texts, broadcast as packed bits."""
    column = df.columns[0]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return states_of(batches, column, hashes_of, bits)

    spark = df.sparkSession
    states = df.coalesce(parallelism(spark)).mapInArrow(build, _STATE)
    merged = states.groupBy("segment").applyInArrow(_merge, "segment int, twice binary")
    out = np.zeros(1 << (bits - 3), np.uint8)
    for row in merged.where(F.col("twice").isNotNull()).toLocalIterator():
        at = row["segment"] * SEGMENT
        part = np.frombuffer(bytes(row["twice"]), np.uint8)
        out[at:at + len(part)] = part
    return spark.sparkContext.broadcast(out)
