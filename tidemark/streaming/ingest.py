"""Micro-batch ingestion: accepted rows and quarantine in one pass, safe to replay."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation

from tidemark.operators.rules import REASON, Rule, mark, verdict_counts
from tidemark.sources.sinks import append_batch

Counts = dict[str, int]


def write_batch(batch: DataFrame, batch_id: int, rules: Sequence[Rule], accepted: str, quarantine: str) -> Counts:
    """Splits a batch into its two tables and counts both sides while writing.

    The batch is kept once for both writes. Each table gets a partition of this batch, so
    a replay after a failure replaces it.
    """
    seen = Observation()
    marked = mark(batch, rules).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        kept = marked.observe(seen, *verdict_counts())
        append_batch(kept.filter(kept[REASON].isNull()).drop(REASON), accepted, batch_id)
        append_batch(marked.filter(marked[REASON].isNotNull()), quarantine, batch_id)
        return dict(seen.get)
    finally:
        marked.unpersist()


def run_ingest(
    stream: DataFrame,
    rules: Sequence[Rule],
    accepted: str,
    quarantine: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> list[Counts]:
    """Reads all files that are new, then stops. Returns the counts of every batch."""
    done: list[Counts] = []

    def each(batch: DataFrame, batch_id: int) -> None:
        ready = prepare(batch) if prepare else batch
        done.append({"batch_id": batch_id, **write_batch(ready, batch_id, rules, accepted, quarantine)})

    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return done
