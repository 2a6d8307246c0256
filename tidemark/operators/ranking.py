"""Global order statistics without a single-partition window.

A window without ``partitionBy`` moves the whole table into one task. Here the rows are
range-partitioned and sorted, their positions are fixed by a checkpoint, and only one
count (or sum) per partition reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, inheritable_thread_target
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import stable

_POS = "__pos"
_PART = "__part"
# monotonically_increasing_id: partition number above these bits, row number below.
_ROW_BITS = 33


@dataclass(frozen=True)
class Key:
    """One ordering column. Nulls sort first ascending and last descending."""

    name: str
    descending: bool = False

    def ordering(self) -> Column:
        return F.desc(self.name) if self.descending else F.asc(self.name)

    def after(self, value: object) -> Column:
        """True for rows strictly behind ``value`` in this order; never null."""
        c = F.col(self.name)
        if self.descending:
            return F.lit(False) if value is None else c.isNull() | (c < F.lit(value))
        return c.isNotNull() if value is None else F.coalesce(c > F.lit(value), F.lit(False))


def _keys(order: Sequence[Key | str]) -> list[Key]:
    return [k if isinstance(k, Key) else Key(k) for k in order]


def _positioned(df: DataFrame, keys: list[Key]) -> DataFrame:
    """Rows in global order; the position column grows along that order."""
    ordering = [k.ordering() for k in keys]
    placed = df.repartitionByRange(*ordering).sortWithinPartitions(*ordering)
    return stable(placed.withColumn(_POS, F.monotonically_increasing_id()))


def _part(c: str = _POS) -> Column:
    return F.shiftright(F.col(c), _ROW_BITS)


def _part_sizes(placed: DataFrame) -> list[tuple[int, int]]:
    """(partition, rows) in order: one row per partition, so bounded by their number."""
    rows = placed.groupBy(_part().alias(_PART)).count().collect()
    return sorted((r[_PART], r["count"]) for r in rows)


def number_rows(df: DataFrame, order: Sequence[Key | str], out: str) -> DataFrame:
    """Global row number from 1. The last key must make the order total."""
    placed = _positioned(df, _keys(order))
    offsets, seen = [], 0
    for part, n in _part_sizes(placed):
        offsets.append((part, seen))
        seen += n
    table = df.sparkSession.createDataFrame(offsets, f"{_PART} long, __offset long")
    local = F.col(_POS).bitwiseAND((1 << _ROW_BITS) - 1)
    return (
        placed.withColumn(_PART, _part())
        .join(F.broadcast(table), _PART)  # one row per partition
        .withColumn(out, F.col("__offset") + local + 1)
        .drop(_PART, _POS, "__offset")
    )


def _after_row(keys: list[Key], row: Sequence[object]) -> Column:
    """True for rows strictly behind ``row`` in the order of all keys."""
    result = F.lit(False)
    for key, value in reversed(list(zip(keys, row))):
        same = F.col(key.name).eqNullSafe(F.lit(value))
        result = key.after(value) | (same & result)
    return result


def _last_rows(total: int, n: int) -> list[int]:
    """The ranks of the last row of every tile but the final one, while tiles have rows."""
    base, extra = divmod(total, n)
    ends, end = [], 0
    for tile in range(1, n):
        width = base + (1 if tile <= extra else 0)
        if width == 0:
            break
        end += width
        ends.append(end)
    return ends


def tile_ends(df: DataFrame, n: int, order: Sequence[Key | str]) -> list[tuple]:
    """Key values of the last row of every tile but the final one (at most ``n - 1``)."""
    return tile_ends_many(df, n, [order])[0]


def _sorted_ends(df: DataFrame, n: int, keys: list[Key]) -> list[tuple]:
    """The ends from a sort of all keys."""
    placed = _positioned(df.select(*[k.name for k in keys]), keys)
    sizes = _part_sizes(placed)
    ends = _last_rows(sum(size for _, size in sizes), n)
    wanted, seen = [], 0
    for part, size in sizes:
        wanted += [(part << _ROW_BITS) + e - seen - 1 for e in ends if seen < e <= seen + size]
        seen += size
    if not wanted:
        return []
    rows = placed.filter(F.col(_POS).isin(wanted)).orderBy(_POS).collect()
    return [tuple(r[k.name] for k in keys) for r in rows]


def tile_of(ends: Sequence[tuple], order: Sequence[Key | str]) -> Column:
    """Tile number from 1, given :func:`tile_ends`: a projection, no shuffle."""
    keys = _keys(order)
    tile = F.lit(1)
    for row in ends:
        tile = tile + _after_row(keys, row).cast("int")
    return tile


#: Ranks of approximate percentiles are off by one in so many rows at most.
ACCURACY = 10_000
#: Rows around an edge that one task ranks.
BRACKET_ROWS = 200_000


def _bracketed(df: DataFrame, n: int, orders: Sequence[list[Key]]) -> dict[int, list[tuple]]:
    """The ends of those orders that can do without a sort, by their place.

    Approximate percentiles give an interval of the first key around every end, an exact count of the rows before it
    the rank within, and only the rows inside are ranked. An order is left out if its first key is no number or has
    nulls, if an interval misses its end, or if too many rows share it.
    """
    numeric = (T.IntegerType, T.LongType, T.ShortType, T.DoubleType, T.FloatType)
    chosen = {i: keys for i, keys in enumerate(orders) if isinstance(df.schema[keys[0].name].dataType, numeric)}
    if not chosen:
        return {}
    shares = [min(1.0, max(0.0, t / n + side * 2 / ACCURACY)) for t in range(1, n) for side in (-1, 1)]
    around = {
        i: F.percentile_approx(keys[0].name, [1 - x for x in reversed(shares)] if keys[0].descending else shares, ACCURACY)
        for i, keys in chosen.items()
    }
    seen = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count(keys[0].name).alias(f"n{i}") for i, keys in chosen.items()],
        *[a.alias(f"p{i}") for i, a in around.items()],
    ).first()
    ends = _last_rows(seen["n"], n)
    if len(ends) < n - 1:
        return {}
    inside, before = {}, []
    for i, keys in chosen.items():
        if seen[f"n{i}"] == seen["n"]:
            c, marks = F.col(keys[0].name), seen[f"p{i}"]
            for t in range(n - 1):
                at = n - 2 - t if keys[0].descending else t
                low, high = F.lit(marks[2 * at]), F.lit(marks[2 * at + 1])
                inside[i, t] = (c >= low) & (c <= high)
                before += [
                    F.count_if(c > high if keys[0].descending else c < low).alias(f"b{i}_{t}"), F.count_if(inside[i, t]).alias(f"w{i}_{t}")
                ]
    if not inside:
        return {}
    counts = df.agg(*before).first()
    fits = lambda i, t: 0 < ends[t] - counts[f"b{i}_{t}"] <= counts[f"w{i}_{t}"] <= BRACKET_ROWS
    good = {i for i in chosen if all((i, t) in inside and fits(i, t) for t in range(n - 1))}
    found: dict[int, list[tuple]] = {}
    for i in good:
        keys = chosen[i]
        tagged = df.select(*[k.name for k in keys], F.explode(F.array_compact(F.array(*[
            F.when(inside[i, t], F.lit(t)) for t in range(n - 1)
        ]))).alias("__tile"))
        ranked = tagged.withColumn("__rank", F.row_number().over(Window.partitionBy("__tile").orderBy(*[k.ordering() for k in keys])))
        last = F.element_at(F.array(*[F.lit(ends[t] - counts[f"b{i}_{t}"]) for t in range(n - 1)]), F.col("__tile") + 1)
        rows = ranked.filter(F.col("__rank") == last).orderBy("__tile").collect()  # n - 1 rows
        found[i] = [tuple(r[k.name] for k in keys) for r in rows]
    return found


def tile_ends_many(df: DataFrame, n: int, orders: Sequence[Sequence[Key | str]]) -> list[list[tuple]]:
    """:func:`tile_ends` for several orders. Give a stored frame: it is read some times.

    Ends are selected without a sort where that is possible; other orders are sorted, side by side.
    """
    every = [_keys(order) for order in orders]
    found = _bracketed(df, n, every) if n > 1 else {}
    left = [i for i in range(len(every)) if i not in found]
    if left:
        one = inheritable_thread_target(df.sparkSession)(lambda i: _sorted_ends(df, n, every[i]))
        with ThreadPool(len(left)) as pool:
            found |= zip(left, pool.map(one, left), strict=True)
    return [found[i] for i in range(len(every))]


def ntile_global(df: DataFrame, n: int, order: Sequence[Key | str], out: str) -> DataFrame:
    """``ntile(n)`` over the whole table. The last key must make the order total.

    Only the key columns are sorted. The rows themselves are then labelled by comparing
    them with the n - 1 tile ends, so a wide table is not shuffled.
    """
    return df.withColumn(out, tile_of(tile_ends(df, n, order), order))


def running_sums(df: DataFrame, order: Sequence[Key | str], sums: dict[str, str]) -> DataFrame:
    """Inclusive running totals over the whole table, ``{output: input}`` of whole numbers; a null adds nothing.

    Every range is summed up where it was sorted, before its checkpoint; the totals of the ranges before it are
    then added without another shuffle.
    """
    ordering = [k.ordering() for k in _keys(order)]
    names = df.columns
    schema = T.StructType([*df.schema.fields, *[T.StructField(c, T.LongType()) for c in [_PART, *sums]]])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), dict.fromkeys(sums, 0)
        for batch in batches:
            out = []
            for o, c in sums.items():
                run = before[o] + np.cumsum(batch.column(c).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
                before[o] = int(run[-1]) if len(run) else before[o]
                out.append(pa.array(run))
            at = pa.array(np.full(batch.num_rows, part, np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, at, *out], names=[*names, _PART, *sums])

    placed = df.repartitionByRange(*ordering).sortWithinPartitions(*ordering)
    summed = stable(placed.mapInArrow(add_up, schema))
    totals = summed.groupBy(_PART).agg(*[F.sum(c).alias(o) for o, c in sums.items()]).collect()  # one row per range
    carry = dict.fromkeys(sums, 0)
    offsets = []
    for row in sorted(totals, key=lambda r: r[_PART]):
        offsets.append((row[_PART], *carry.values()))
        carry = {o: carry[o] + (row[o] or 0) for o in sums}
    table = df.sparkSession.createDataFrame(offsets, f"{_PART} long, " + ", ".join(f"__carry_{o} long" for o in sums))
    out = summed.join(F.broadcast(table), _PART)  # one row per range
    return out.select(*names, *[(F.col(o) + F.col(f"__carry_{o}")).alias(o) for o in sums])
