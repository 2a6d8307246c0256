"""Helpers shared by the text operators: stored intermediates, joins that survive hot keys, batches in parts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.sizes import small
from tidemark.session import run_dir

#: ``[\x20\x09-\x0D]``, the white space that separates words and frames line keys.
SPACES = " \t\n\x0b\x0c\r"

#: A key is heavy if it holds more than one in this many rows, so at most this many keys are heavy.
HEAVY_SHARE = 1_000

#: Bytes of a batch's texts or ids that are handled together; a longer row is a part of its own.
PART_BYTES = 4 << 20

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def store(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """The frame written to the shared scratch folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = run_dir(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def fresh(name: str, columns: list[str]) -> str:
    """A column name that clashes with none of ``columns``."""
    while name in columns:
        name += "_"
    return name


def join_weighted(rows: DataFrame, right: DataFrame, key: str, weight: str, total: int, how: str) -> DataFrame:
    """``rows`` joined with ``right``, whose ``key`` is unique and whose ``weight`` counts the rows under it.

    Keys over 1/1000 of ``total`` are at most 1000 and go to every task; the others are small groups and are
    shuffled. ``how`` is inner or left; null keys match nothing.
    """
    heavy = F.col(weight) * HEAVY_SHARE > total
    hot = F.broadcast(right.where(heavy))
    rest = rows.join(hot.select(key), key, "left_anti").join(right.where(~heavy), key, how)
    return rows.join(hot, key, "inner").unionByName(rest)


def parts_of(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in parts of at most ``PART_BYTES`` in column ``name``.

    What Arrow's pool holds unused goes back after each part: workers stay between stages, and executors have little
    memory beside their heap.
    """
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + PART_BYTES, side="right")))
            yield batch.slice(start, end - start)
            pa.default_memory_pool().release_unused()
            start = end


def parallelism(spark: SparkSession) -> int:
    return max(1, spark.sparkContext.defaultParallelism)


__all__ = [
    "HEAVY_SHARE", "PART_BYTES", "SPACES", "Query", "fresh", "join_weighted", "parallelism", "parts_of", "small", "store",
    "table", "text_of",
]
