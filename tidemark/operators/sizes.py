"""Broadcast hints behind a measured size.

Without one, both sides of a join are shuffled before adaptive execution learns that one
was small: for a large table against a few keys that is the whole cost.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest side sent to every executor.
BROADCAST_BYTES = 64 << 20
_ROW_BYTES = 32


def measured_bytes(df: DataFrame) -> int:
    """Size of a frame of plain columns: text lengths plus a fixed share per row and column.

    Nested and binary columns have no such bound and are refused.
    """
    nested = [c for c, kind in df.dtypes if kind.startswith(("array", "map", "struct", "binary", "variant"))]
    if nested:
        raise ValueError(f"not plain columns: {nested}")
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in df.dtypes if kind == "string"]
    row = reduce(lambda a, b: a + b, texts, F.lit(_ROW_BYTES + 8 * len(df.columns)))
    return df.agg(F.sum(row.cast("long")).alias("b")).first()["b"] or 0


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The frame with a broadcast hint if it measures up to ``limit``, else as it is.

    It is computed for the measurement, so it should be cheap, kept or checkpointed.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df
