"""Writes: idempotent batches, slices, full overwrites, result logs."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import remove_folder, subfolders

_DYNAMIC = {"partitionOverwriteMode": "dynamic"}


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replaces the whole table, schema included.

    Rows of a partition are brought together first, in evenly sized pieces, so the number
    of files follows the data and not tasks times partitions.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append_batch(
    df: DataFrame, path: str, batch_id: int, batch_col: str = "batch_id", within: Sequence[str] = ()
) -> None:
    """Adds a batch as its own partition: writing the same batch again changes nothing.

    New columns are allowed: readers give the grown schema, or merge (:func:`read_merged`).
    ``within`` names columns that part the batch further.
    """
    tagged = df.withColumn(batch_col, F.lit(batch_id).cast("long"))
    tagged.write.mode("overwrite").options(**_DYNAMIC).partitionBy(batch_col, *within).parquet(path)


def batch_ids(spark: SparkSession, path: str, batch_col: str = "batch_id") -> list[int]:
    """Numbers of the stored batches, from the folder names."""
    prefix = f"{batch_col}="
    return sorted(int(n.removeprefix(prefix)) for n in subfolders(spark, path) if n.startswith(prefix))


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """All columns any file has. This opens every file; give large tables a stored schema."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def replace_slice(df: DataFrame, path: str, col: str, value: object) -> None:
    """Replaces the rows with ``col = value`` and leaves all other slices alone.

    Without new rows the slice is emptied: its folder goes, as a write would leave it alone.
    """
    typed = F.lit(value).cast(df.schema[col].dataType)
    part = df.filter(F.col(col) == typed)
    if part.isEmpty():
        spark = df.sparkSession
        name = spark.range(1).select(typed.cast("string")).first()[0]
        for folder in subfolders(spark, path):
            if unquote(folder) == f"{col}={name}":
                remove_folder(spark, f"{path.rstrip('/')}/{folder}")
        return
    part.hint("rebalance").write.mode("overwrite").options(**_DYNAMIC).partitionBy(col).parquet(path)


def replace_folders(df: DataFrame, path: str, cols: Sequence[str], values: Sequence[tuple]) -> None:
    """Replaces the partitions ``values`` of ``cols`` by the rows of ``df``, which has no others.

    Partitions without new rows are emptied; all others are left alone.
    """
    if not values:
        return
    df = df.persist()
    try:
        df.hint("rebalance", *cols).write.mode("overwrite").options(**_DYNAMIC).partitionBy(*cols).parquet(path)
        present = {tuple(r) for r in df.select(*cols).distinct().collect()}  # partitions
    finally:
        df.unpersist()
    for value in set(values) - present:
        remove_folder(df.sparkSession, "/".join([path.rstrip("/"), *[f"{c}={v}" for c, v in zip(cols, value, strict=True)]]))


def append_results(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
