"""Dedup, unions, counts, top-n, version comparison and table contracts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str) -> DataFrame:
    """First ``n`` rows per key with their rank.

    The rank filter becomes a group limit in front of the shuffle: every task sends at
    most ``n`` rows per key, so a hot key does not fill one task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``, which must be total for a fixed result."""
    return top_per_group(df, keys, order, 1, "__rn").drop("__rn")


def content_hash(df: DataFrame) -> Column:
    """Last ordering key where no column makes the order total."""
    return F.xxhash64(*[F.col(c) for c in sorted(df.columns)])


def dedup_by_ingestion(df: DataFrame, key: str = "id_transacao") -> DataFrame:
    """Latest row per transaction: ingestion time, then event time, then content."""
    order = [F.desc("_ingestion_time"), F.desc("dt_transacao"), content_hash(df)]
    return dedup_latest(df, [key], order)


def union_sources(*feeds: DataFrame) -> DataFrame:
    """All rows of all feeds; a column some feed lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Join by columns of equal names where null equals null; ``on`` stays as in ``left``."""
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in on else F.col(c) for c in right.columns])
    same = reduce(lambda a, b: a & b, [left[c].eqNullSafe(renamed[f"__r_{c}"]) for c in on])
    return left.join(renamed, same, how).drop(*[f"__r_{c}" for c in on])


def count_by(df: DataFrame, *cols: str, out: str = "n") -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(out))


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def read_since(df: DataFrame, ts: str, low: object = None, high: object = None) -> DataFrame:
    """Rows with ``low <= ts < high``; a missing bound is open."""
    # Bounds take the type of the column: a cast on the column would keep them from the scan.
    kind = df.schema[ts].dataType
    if low is not None:
        df = df.filter(F.col(ts) >= F.lit(low).cast(kind))
    if high is not None:
        df = df.filter(F.col(ts) < F.lit(high).cast(kind))
    return df


def last_days(df: DataFrame, ts: str, ref: str, days: int) -> DataFrame:
    """Rows of the ``days`` before ``ref`` and of that day.

    Bounds apply to the raw column, so they reach the scan and its statistics.
    """
    kind = df.schema[ts].dataType
    low = F.date_sub(F.lit(ref).cast("date"), days).cast(kind)
    high = F.date_add(F.lit(ref).cast("date"), 1).cast(kind)
    return df.filter((F.col(ts) >= low) & (F.col(ts) < high))


def backfill(df: DataFrame, ts: str, ref: str, days: int = 90) -> DataFrame:
    """History for a first load: everything from ``days`` before ``ref`` on."""
    low = F.date_sub(F.lit(ref).cast("date"), days).cast(df.schema[ts].dataType)
    return df.filter(F.col(ts) >= low)


def apply_retention(df: DataFrame, ts: str, days: int, ref: str) -> DataFrame:
    """Rows not older than the retention of their layer."""
    return backfill(df, ts, ref, days)


#: Key buckets whose digests are compared before any row is moved.
DIFF_BUCKETS = 4_096


def _digests(df: DataFrame, keys: Sequence[str], values: Sequence[str], buckets: int) -> DataFrame:
    """Keys, the bucket they fall into, and two digests of the whole row."""
    return df.select(
        *keys, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("__bucket"),
        *[F.xxhash64(F.lit(i), *keys, *values).cast("decimal(38,0)").alias(f"__d{i}") for i in (0, 1)],
    )


def differing_buckets(a: DataFrame, b: DataFrame) -> DataFrame:
    """Buckets in which two digested frames do not hold the same rows as often: at most one row per bucket."""
    totals = [
        side.groupBy("__bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("__d0").alias("d0"), F.sum("__d1").alias("d1"))
        for side in (a, b)
    ]
    # Equal totals of both sides fall together, so a bucket that differs has a total of one side alone.
    either = totals[0].unionByName(totals[1]).groupBy("__bucket", "n", "d0", "d1").count()
    return either.filter("count = 1").select("__bucket").distinct()


def diff_versions(old: DataFrame, new: DataFrame, keys: Sequence[str], buckets: int = DIFF_BUCKETS, copies: bool = False) -> DataFrame:
    """Keys that differ between two versions, with ``change`` added / removed / changed.

    Null keys are keys, and rows that repeat count: a key differs if one side has a row more often. ``copies`` adds
    how many rows either side has (``n_old``, ``n_new``).

    Each side is first summed up per key bucket, which shuffles one row per bucket and task. Only rows of buckets
    that differ are then moved, as keys and digests, to one grouping that adds up before its shuffle.
    """
    values = [c for c in new.columns if c not in keys]
    sides = [_digests(df, keys, values, buckets) for df in (old, new)]
    differ = F.broadcast(differing_buckets(*sides))  # ``buckets`` rows at most
    tagged = [s.join(differ, "__bucket", "left_semi").withColumn("__new", F.lit(i == 1)) for i, s in enumerate(sides)]
    of = lambda i, c: F.coalesce(F.sum(F.when(F.col("__new") == F.lit(i == 1), F.col(c))), F.lit(0))
    grouped = tagged[0].unionByName(tagged[1]).groupBy(*keys).agg(
        F.count_if(~F.col("__new")).alias("n_old"), F.count_if(F.col("__new")).alias("n_new"),
        (of(0, "__d0") - of(1, "__d0")).alias("__d0"), (of(0, "__d1") - of(1, "__d1")).alias("__d1"),
    )
    change = F.when(F.col("n_old") == 0, "added").when(F.col("n_new") == 0, "removed").otherwise("changed")
    differs = (F.col("n_old") != F.col("n_new")) | (F.col("__d0") != 0) | (F.col("__d1") != 0)
    return grouped.filter(differs).select(*keys, change.alias("change"), *(["n_old", "n_new"] if copies else []))


def conform(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """The declared columns in declared order and type; missing ones are null, extra ones dropped."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ])


def contract_gaps(df: DataFrame, schema: T.StructType | str) -> dict[str, list[str]]:
    """Columns missing from the frame, not in the contract, or of another type."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    declared = {f.name: f.dataType for f in schema}
    found = {f.name: f.dataType for f in df.schema}
    return {
        "missing": [c for c in declared if c not in found],
        "extra": [c for c in found if c not in declared],
        "retyped": [c for c in declared if c in found and found[c] != declared[c]],
    }


def contract_breaks(df: DataFrame, schema: T.StructType | str, out: str = "problem") -> DataFrame:
    """Rows with the first declared column that must not be null and is: what a write would refuse."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    broken = F.lit(None).cast("string")
    for f in reversed([f for f in schema if not f.nullable]):
        broken = F.when(F.col(f.name).isNull(), f"{f.name} nulo").otherwise(broken)
    return df.withColumn(out, broken)


class ContractError(RuntimeError):
    """Rows or columns that a table's contract does not allow."""


def enforced(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """The frame in the contract's columns, order and types, for a write.

    A missing or retyped column is an error at once, a null in a column declared NOT NULL when the row is written: the
    job then fails as a whole, and no part of it is committed.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    gaps = contract_gaps(df, schema)
    if gaps["missing"] or gaps["retyped"]:
        raise ContractError(f"missing columns {gaps['missing']}, of another type {gaps['retyped']}")
    checked = []
    for f in schema:
        value = F.col(f.name)
        if not f.nullable:
            value = F.coalesce(value, F.raise_error(F.lit(f"{f.name}: null where the contract has NOT NULL")).cast(f.dataType))
        checked.append(value.alias(f.name))
    return df.select(*checked)


def pii_access(df: DataFrame, actions: Sequence[str], tables: Sequence[str]) -> DataFrame:
    """Reads of the given tables in an access log with nested identity and request, newest first."""
    return (
        df.filter(
            F.col("action_name").isin(*actions)
            & F.col("request_params.table_full_name").isin(*tables)
        )
        .select(
            F.col("user_identity.email").alias("usuario"),
            "event_time",
            F.col("request_params.table_full_name").alias("tabela"),
            "action_name",
            "source_ip_address",
        )
        .orderBy(F.desc("event_time"))
    )
