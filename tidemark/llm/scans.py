"""Running counts, sums and prefix numbers per key, whatever part of the rows one key holds.

Rows are placed in ranges of key and order. Every task scans its range; what a key had at the end of the ranges
before is added afterwards. One row per range reaches the driver, so a key over many ranges is as good as many keys.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import store

#: Odd factors of the prefix numbers, one for each numbered column.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_WRAP = 1 << 64


def _powers(factor: int, top: int) -> np.ndarray:
    """``factor`` to the power of 0 .. top, modulo 2^64."""
    out = np.full(top + 1, factor, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class _State:
    """The last key of a scan, with its count, sums and prefix numbers so far."""

    def __init__(self, key: int | None = None, n: int = 0, sums: Sequence[int] = (), marks: Sequence[int] = ()) -> None:
        self.key, self.n, self.sums, self.marks = key, n, tuple(sums), tuple(marks)


def _scan(keys: np.ndarray, sums: list[np.ndarray], marks: list[np.ndarray], state: _State):
    """(n, running sums, prefix numbers) of rows in order, going on from ``state``."""
    rows = np.arange(len(keys))
    first = np.maximum.accumulate(np.where(np.r_[True, keys[1:] != keys[:-1]], rows, 0))
    n = rows - first + 1
    totals = [np.cumsum(x) for x in sums]
    totals = [t - t[first] + x[first] for t, x in zip(totals, sums, strict=True)]
    prefixes = []
    for x, factor in zip(marks, FACTORS, strict=False):
        # The recurrence p = p * factor + x, as a sum of x over the inverse powers.
        up, down = _powers(factor, int(n.max())), _powers(pow(factor, -1, _WRAP), int(n.max()))
        part = x * down[n]
        run = np.cumsum(part)
        prefixes.append(up[n] * (run - run[first] + part[first]))
    if len(keys) and state.n and keys[0] == state.key:
        _carry(first == 0, n, totals, prefixes, state)
    return n, totals, prefixes


def _carry(at: np.ndarray, n: np.ndarray, totals: list[np.ndarray], prefixes: list[np.ndarray], state: _State) -> None:
    """Puts ``state`` before the rows ``at``, in place."""
    for p, factor, mark in zip(prefixes, FACTORS, state.marks, strict=False):
        p[at] += np.uint64(mark) * _powers(factor, int(n[at].max()))[n[at]]
    for t, s in zip(totals, state.sums, strict=True):
        t[at] += s
    n[at] += state.n


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def running(df: DataFrame, key: str, order: Sequence[Column], sums: Sequence[str] = (), marks: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``n`` (the row's place in its key, from 1), ``<sum>_run`` and, for every mark, ``<mark>_prefix``.

    ``key``, ``sums`` and ``marks`` are long columns without nulls. A prefix number stands for all marks of the key up
    to the row, in order; ``<mark>_before`` is that of the row before. The result is stored.
    """
    names = df.columns
    added = ["n", *[f"{c}_run" for c in sums], *[f"{c}_prefix" for c in marks]]
    kept = ", ".join(f"`{c}` {kind}" for c, kind in df.dtypes)
    schema = f"{kept}, part int, {', '.join(f'{c} long' for c in added)}"

    def read(batch: pa.RecordBatch, columns: Sequence[str]) -> list[np.ndarray]:
        return [batch.column(c).to_numpy().astype(np.int64) for c in columns]

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, state = TaskContext.get().partitionId(), _State()
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key).to_numpy()
            n, totals, prefixes = _scan(keys, read(batch, sums), [x.view(np.uint64) for x in read(batch, marks)], state)
            state = _State(keys[-1], int(n[-1]), [int(t[-1]) for t in totals], [int(p[-1]) for p in prefixes])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(np.full(len(n), part, np.int32)), pa.array(n),
                 *map(pa.array, totals), *map(_signed, prefixes)],
                names=[*names, "part", *added],
            )

    ordering = [F.col(key).asc(), *order]
    placed = df.repartitionByRange(*ordering).sortWithinPartitions(*ordering)
    scanned = store(placed.mapInArrow(local, schema), "scanned")
    ends = scanned.groupBy("part").agg(
        F.min(key).alias("first"), F.max(key).alias("last"), F.max_by(F.struct(*added), F.struct(key, "n")).alias("end")
    ).collect()
    carried, state = {}, _State()
    for r in sorted(ends, key=lambda r: r["part"]):
        now = [r["end"][c] for c in added]
        s, m = now[1:1 + len(sums)], [x % _WRAP for x in now[1 + len(sums):]]
        if state.n and r["first"] == state.key:
            carried[r["part"]] = state
            if r["last"] == state.key:
                grown = [pow(f, now[0], _WRAP) * old + new for f, old, new in zip(FACTORS, state.marks, m, strict=False)]
                now[0], s = now[0] + state.n, [a + b for a, b in zip(s, state.sums, strict=True)]
                m = [x % _WRAP for x in grown]
        state = _State(r["last"], now[0], s, m)

    before = [f"{c}_before" for c in marks]

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, parts = batch.column(key).to_numpy(), batch.column("part").to_numpy()
            n, *rest = [x.copy() for x in read(batch, added)]
            totals, prefixes = rest[:len(sums)], [x.view(np.uint64) for x in rest[len(sums):]]
            for part in np.unique(parts).tolist():
                if part in carried:
                    at = (parts == part) & (keys == carried[part].key)
                    if at.any():
                        _carry(at, n, totals, prefixes, carried[part])
            earlier = [
                (p - x.view(np.uint64)) * np.uint64(pow(f, -1, _WRAP))
                for p, x, f in zip(prefixes, read(batch, marks), FACTORS, strict=False)
            ]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(n), *map(pa.array, totals), *map(_signed, prefixes), *map(_signed, earlier)],
                names=[*names, *added, *before],
            )

    return scanned.mapInArrow(whole, f"{kept}, {', '.join(f'{c} long' for c in [*added, *before])}")
