"""Upkeep of the gold tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from tidemark.operators.layout import compact
from tidemark.sources.snapshots import SnapshotTable

# Columns most queries filter on, per gold table.
GOLD_CLUSTERING = {
    "receita_diaria": ["id_cliente", "dt_ref"],
    "rfm_clientes": ["segmento", "rfm_score"],
    "kpis_executivos": [],
}


def maintain(spark: SparkSession, folder: str, tables: Mapping[str, Sequence[str]] = GOLD_CLUSTERING) -> dict[str, dict[str, int]]:
    """Rewrites every table of a folder with even, clustered files."""
    return {
        name: compact(spark, f"{folder.rstrip('/')}/{name}", cluster_by=cols)
        for name, cols in tables.items()
    }


def maintain_snapshots(spark: SparkSession, paths: Mapping[str, Sequence[str]], at: dt.datetime, hours: int = 168) -> dict[str, int]:
    """Optimises versioned tables and removes their expired versions; returns how many."""
    removed = {}
    for path, cols in paths.items():
        table = SnapshotTable(spark, path)
        table.optimize(at, cols)
        removed[path] = table.expire(at, hours, dry_run=False).count()
    return removed
