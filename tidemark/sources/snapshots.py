"""Versioned tables as plain parquet: one partition per version and a commit list.

A version is visible once its commit row exists, so a failed write leaves no trace in
reads. Commit rows are one per version.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.layout import clustered, rebalanced
from tidemark.session import has_rows_stored, remove_folder

VERSION = "snapshot_id"
_COMMITS = "version long, timestamp timestamp, operation string, rows long"


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # --- commits ---

    def _log(self) -> DataFrame | None:
        path = f"{self.path}/commits"
        if not has_rows_stored(self.spark, path):
            return None
        return self.spark.read.schema(_COMMITS).parquet(path)

    def commits(self) -> DataFrame:
        """Live versions: those written and not expired."""
        log = self._log()
        if log is None:
            return self.spark.createDataFrame([], _COMMITS)
        gone = log.filter(F.col("operation") == "EXPIRE").select("version")
        return log.filter(F.col("operation") != "EXPIRE").join(gone, "version", "left_anti")

    def _last(self) -> int:
        log = self._log()
        if log is None:
            return -1
        last = log.agg(F.max("version")).first()[0]
        return -1 if last is None else last

    def _commit(self, rows: Sequence[tuple]) -> None:
        made = self.spark.createDataFrame(list(rows), _COMMITS)
        made.coalesce(1).write.mode("append").parquet(f"{self.path}/commits")

    def history(self, n: int = 10) -> DataFrame:
        """Newest versions first."""
        return self.commits().orderBy(F.desc("version")).limit(n)

    def resolve(self, version: int | None = None, timestamp: dt.datetime | None = None) -> int:
        """Number of a version, of the one valid at a time, or of the newest."""
        live = self.commits()
        if version is not None:
            live = live.filter(F.col("version") == version)
        elif timestamp is not None:
            live = live.filter(F.col("timestamp") <= F.lit(timestamp))
        found = live.agg(F.max("version")).first()[0]
        if found is None:
            raise LookupError(f"{self.path}: no such version")
        return found

    # --- data ---

    def _folder(self, version: int) -> str:
        return f"{self.path}/data/{VERSION}={version}"

    def write(self, df: DataFrame, at: dt.datetime, operation: str = "WRITE", partition_by: Sequence[str] = ()) -> int:
        """Stores a new version and returns its number. Rows are counted while writing."""
        version = self._last() + 1
        seen = Observation()
        writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.option("partitionOverwriteMode", "static").parquet(self._folder(version))
        self._commit([(version, at, operation, seen.get["rows"])])
        return version

    def read(self, version: int | None = None, timestamp: dt.datetime | None = None) -> DataFrame:
        """One version; only its own files are listed."""
        return self.spark.read.parquet(self._folder(self.resolve(version, timestamp)))

    def read_all(self) -> DataFrame:
        """All live versions with their number, for comparing them."""
        live = [r["version"] for r in self.commits().select("version").collect()]  # one row per version
        frames = [self.read(v).withColumn(VERSION, F.lit(v).cast("long")) for v in sorted(live)]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

    # --- upkeep ---

    def restore(self, at: dt.datetime, version: int | None = None, timestamp: dt.datetime | None = None) -> int:
        """Writes an old version again as the newest one; nothing is lost."""
        if version is None and timestamp is None:
            raise ValueError("give a version or a timestamp")
        return self.write(self.read(version, timestamp), at, "RESTORE")

    def clone(self, path: str, at: dt.datetime, version: int | None = None) -> SnapshotTable:
        """An independent copy of one version as version 0 of another table."""
        copy = SnapshotTable(self.spark, path)
        copy.write(self.read(version), at, "CLONE")
        return copy

    def optimize(self, at: dt.datetime, cluster_by: Sequence[str] = ()) -> int:
        """The newest version with evenly sized files, clustered on columns where given."""
        df = self.read()
        return self.write(clustered(df, cluster_by) if cluster_by else rebalanced(df), at, "OPTIMIZE")

    def expired(self, now: dt.datetime, hours: int = 168) -> DataFrame:
        """Versions superseded for longer than ``hours``; never the newest."""
        cutoff = now - dt.timedelta(hours=hours)
        newest = self.commits().agg(F.max("version").alias("newest"))
        return self.commits().filter(
            (F.col("timestamp") < F.lit(cutoff)) & (F.col("version") < F.coalesce(newest.scalar(), F.lit(-1)))
        )

    def expire(self, now: dt.datetime, hours: int = 168, dry_run: bool = True) -> DataFrame:
        """Lists the expired versions and, unless it is a dry run, removes them.

        They leave the commit list first, so no reader meets a half-removed version.
        """
        rows = self.expired(now, hours).collect()  # one row per version
        if rows and not dry_run:
            self._commit([(r["version"], now, "EXPIRE", r["rows"]) for r in rows])
            for r in rows:
                remove_folder(self.spark, self._folder(r["version"]))
        return self.spark.createDataFrame(rows, _COMMITS)
