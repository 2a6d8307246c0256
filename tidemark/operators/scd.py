"""Slowly-changing history: full build, incremental step and reads.

The history of a key needs its rows in time order. One key may hold a large part of the
table, so keys found to be hot are cut into time slices: each slice is worked on alone
and only its edge is handed to the next one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.relational import join_null_safe
from tidemark.operators.sizes import small
from tidemark.session import stable

# A key is hot when it has more rows than this; a window task sorts up to as many.
HOT_ROWS = 5_000_000
# Hash buckets in which keys are counted to find the hot ones.
_BUCKETS = 65_536

_SLICE = "__slice"


@dataclass(frozen=True)
class Versions:
    """Column names of the history: key, tracked attributes, event time, tie-breakers."""

    key: str
    tracked: Sequence[str]
    ts: str
    ties: Sequence[str] = ()
    start: str = "dt_inicio"
    end: str = "dt_fim"
    flag: str = "is_current"

    def state(self) -> Column:
        return F.struct(*[F.col(c) for c in self.tracked])

    def time(self) -> list[str]:
        return [self.ts, *self.ties]


def hot_keys(df: DataFrame, key: str, limit: int) -> dict[object, int]:
    """Keys with more rows than ``limit``, and how many.

    Rows are first counted per hash bucket of the key, which shrinks to the buckets before
    the shuffle. Only keys of buckets above the limit are then counted, in any number of
    tasks. The limit is the same for every table; at most rows / limit keys are above it.
    Null is a key like any other.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(_BUCKETS))
    keyed = df.select(key)
    sizes = keyed.groupBy(bucket.alias("b")).count().collect()  # at most _BUCKETS rows
    full = [r["b"] for r in sizes if r["count"] > limit]
    if not full:
        return {}
    counts = keyed.filter(bucket.isin(full)).groupBy(key).count()
    return {r[key]: r["count"] for r in counts.filter(F.col("count") > limit).collect()}


def _close(df: DataFrame, v: Versions) -> DataFrame:
    return df.withColumn(v.start, F.col(v.ts)).withColumn(v.flag, F.col(v.end).isNull())


def _plain(df: DataFrame, v: Versions) -> DataFrame:
    w = Window.partitionBy(v.key).orderBy(*v.time())
    changed = df.withColumn("__prev", F.lag(v.state()).over(w)).filter(
        ~v.state().eqNullSafe(F.col("__prev"))
    )
    return _close(changed.drop("__prev").withColumn(v.end, F.lead(v.ts).over(w)), v)


def _sliced(df: DataFrame, v: Versions, slices: int) -> DataFrame:
    """Same result as :func:`_plain`; no task holds more than one slice of one key.

    Range partitions over key and time are the slices. They are equally full whatever
    the key or time distribution, and the checkpoint keeps them the same in all branches.
    """
    ranged = df.repartitionByRange(slices, v.key, *v.time())
    cut = stable(ranged.withColumn(_SLICE, F.spark_partition_id()))
    by_slice = Window.partitionBy(v.key, _SLICE).orderBy(*v.time())
    over_slices = Window.partitionBy(v.key).orderBy(_SLICE)  # one row per slice

    carried = (
        cut.groupBy(v.key, _SLICE)
        .agg(F.max_by(v.state(), F.struct(*v.time())).alias("__last"))
        .withColumn("__carry", F.lag("__last").over(over_slices))
        .drop("__last")
    )
    prev = F.coalesce(F.lag(v.state()).over(by_slice), F.col("__carry"))
    changed = (
        join_null_safe(cut, carried, [v.key, _SLICE], "inner")
        .withColumn("__prev", prev)
        .filter(~v.state().eqNullSafe(F.col("__prev")))
        .drop("__prev", "__carry")
    )
    following = (
        changed.groupBy(v.key, _SLICE)
        .agg(F.min(v.ts).alias("__first"))
        .withColumn("__next", F.lead("__first").over(over_slices))
        .drop("__first")
    )
    end = F.coalesce(F.lead(v.ts).over(by_slice), F.col("__next"))
    closed = join_null_safe(changed, following, [v.key, _SLICE], "inner").withColumn(v.end, end)
    return _close(closed.drop("__next", _SLICE), v)


def scd2_history(
    df: DataFrame,
    v: Versions,
    hot_rows: int = HOT_ROWS,
    hot: dict[object, int] | None = None,
) -> DataFrame:
    """All versions: runs of unchanged state collapse, each ends where the next starts.

    ``ts`` with ``ties`` must order the rows of a key without ties. ``hot`` passes the
    result of :func:`hot_keys` where it is known already.
    """
    if hot is None:
        hot = hot_keys(df, v.key, hot_rows)
    if not hot:
        return _plain(df, v)
    is_hot = F.coalesce(F.col(v.key).isin([k for k in hot if k is not None]), F.lit(None in hot))
    slices = max(2, -(-sum(hot.values()) // hot_rows))
    return _plain(df.filter(~is_hot), v).unionByName(_sliced(df.filter(is_hot), v, slices))


@dataclass(frozen=True)
class Applied:
    """Result of one incremental step."""

    current: DataFrame
    closed: DataFrame
    late: DataFrame


def scd2_init(df: DataFrame, v: Versions) -> DataFrame:
    """First load of a frame with one row per key: everything is current."""
    end = F.lit(None).cast(df.schema[v.ts].dataType)
    return df.withColumn(v.start, F.col(v.ts)).withColumn(v.end, end).withColumn(v.flag, F.lit(True))


SEED = "__seed"


def advance(touched: DataFrame, batch: DataFrame, v: Versions, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """(versions, late rows) for the keys of a batch.

    ``touched`` holds the current row of those keys that have one. It becomes the seed of
    the key's history and is marked in the result. Batch rows not later than their seed,
    and those without a time, are late: they start no version. Several changes of a key in one batch give several versions. Columns only
    one side has are null in the rows of the other.
    """
    payload = [c for c in batch.columns if c not in (v.start, v.end, v.flag)]
    starts = touched.select(v.key, F.col(v.start).alias("__since"))
    dated = join_null_safe(batch.select(*payload), starts, [v.key], "left")
    is_late = F.col(v.ts).isNull() | F.coalesce(F.col(v.ts) <= F.col("__since"), F.lit(False))
    fresh = dated.filter(~is_late).drop("__since").withColumn(SEED, F.lit(False))
    # A current row stands for its whole run, so it enters at the start of that run.
    seeds = touched.withColumn(v.ts, F.col(v.start)).drop(v.start, v.end, v.flag).withColumn(SEED, F.lit(True))
    # Seeds add one row per key, so the batch alone tells which keys are hot.
    hot = hot_keys(batch, v.key, hot_rows)
    versions = scd2_history(seeds.unionByName(fresh, allowMissingColumns=True), v, hot_rows, hot)
    return versions, dated.filter(is_late).drop("__since")


def scd2_apply(current: DataFrame, batch: DataFrame, v: Versions, hot_rows: int = HOT_ROWS) -> Applied:
    """Fold a batch into the current rows (one per key); other keys pass through."""
    keys = small(batch.select(v.key).distinct())
    versions, late = advance(join_null_safe(current, keys, [v.key], "left_semi"), batch, v, hot_rows)
    versions = versions.drop(SEED)
    return Applied(
        current=join_null_safe(current, keys, [v.key], "left_anti").unionByName(
            versions.filter(F.col(v.flag)), allowMissingColumns=True
        ),
        closed=versions.filter(~F.col(v.flag)),
        late=late,
    )


def current(df: DataFrame, v: Versions) -> DataFrame:
    return df.filter(F.col(v.flag))


def as_of(df: DataFrame, v: Versions, ts: object) -> DataFrame:
    """The version of every key that was valid at ``ts``."""
    at = F.lit(ts).cast(df.schema[v.start].dataType)
    return df.filter((F.col(v.start) <= at) & (F.col(v.end).isNull() | (F.col(v.end) > at)))


def scd2_summary(df: DataFrame, v: Versions, by: str) -> DataFrame:
    """Rows by attribute and current flag."""
    return df.groupBy(by, v.flag).agg(F.count(F.lit(1)).alias("n"))
