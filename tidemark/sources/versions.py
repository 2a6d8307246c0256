"""History kept as appended versions, so that a batch costs what the batch holds.

``versions`` gains the new versions of every batch, ``closures`` the end of those it
ended. Open versions without a closure are current. ``fold`` merges the two from time to
time. A batch is visible once its commit row exists; running it again replaces its parts.

Within a batch, rows lie in folders by whether they were open when written, by key bucket and by
month of their event time. The keys of a batch name the buckets that hold their versions, so a
batch lists and opens no others; current rows are read from the open folders alone, and a reader
that needs certain months opens only those.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.relational import join_null_safe
from tidemark.operators.scd import HOT_ROWS, SEED, Versions, advance, scd2_init
from tidemark.operators.sizes import small
from tidemark.session import has_rows_stored, remove_folder
from tidemark.sources.files import evolve_schema
from tidemark.sources.sinks import append_batch, batch_ids

_COMMITS = "batch_id long, generation long, mark timestamp, schema string, progress string, buckets int, months array<string>"

# Folders of a key each; enough that a bucket of a folded table is some files.
BUCKETS = 64
_OPEN, _BUCKET, _MONTH = "__open", "__bucket", "__month"
_PLACES = {"versions": [_OPEN, _BUCKET, _MONTH], "closures": [_BUCKET], "late": []}
_KINDS = {_OPEN: T.BooleanType(), _BUCKET: T.IntegerType(), _MONTH: T.StringType(), "batch_id": T.LongType()}


class State(NamedTuple):
    """The last commit: its numbers, the schema of all versions, and what the caller noted."""

    batch_id: int = -1
    generation: int = 0
    mark: dt.datetime | None = None
    schema: str | None = None
    progress: str | None = None
    buckets: int | None = None
    #: Months whose current rows the batch has changed.
    months: list[str] | None = None

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


class VersionStore:
    """``buckets`` counts for a new store; one that holds batches keeps the number it has."""

    def __init__(self, spark: SparkSession, path: str, v: Versions, buckets: int = BUCKETS):
        self.spark, self.path, self.v, self.buckets = spark, path.rstrip("/"), v, buckets

    def state(self) -> State:
        """The last commit; batch -1 for an empty store."""
        if not has_rows_stored(self.spark, f"{self.path}/commits"):
            return State()
        commits = self.spark.read.schema(_COMMITS).parquet(f"{self.path}/commits")
        return State(*commits.agg(F.max_by(F.struct("*"), "batch_id").alias("c")).first()["c"])

    def touched_months(self, since: int) -> list[str]:
        """Months in which batches after ``since`` started or ended a version. A fold changes none."""
        commits = self.spark.read.schema(_COMMITS).parquet(f"{self.path}/commits").filter(F.col("batch_id") > since)
        return sorted(r["m"] for r in commits.select(F.explode("months").alias("m")).distinct().collect())

    def _commit(self, state: State) -> None:
        row = self.spark.createDataFrame([tuple(state)], _COMMITS)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/commits")

    def _folder(self, kind: str, generation: int) -> str:
        return f"{self.path}/{kind}/{generation}"

    def _bucket(self, state: State) -> Column:
        return F.pmod(F.xxhash64(self.v.key), F.lit(state.buckets or self.buckets)).cast("int")

    def _month(self, c: str) -> Column:
        return F.coalesce(F.date_format(c, "yyyy-MM"), F.lit("none"))

    def _committed(
        self, kind: str, state: State, buckets: Sequence[int] | None = None, open_only: bool = False,
        months: Sequence[str] | None = None,
    ) -> DataFrame | None:
        """Rows of the committed batches. The schema comes from the commit, so no file is opened for it.

        All conditions are on folders: others are not listed into the scan.
        """
        v, folder = self.v, self._folder(kind, state.generation)
        paths = [f"{folder}/batch_id={n}" for n in batch_ids(self.spark, folder) if n <= state.batch_id]
        if not paths:
            return None
        edges = [v.start, v.end, v.flag]
        chosen = {
            "versions": lambda c: True,
            "closures": lambda c: c in (v.key, v.start, v.end),
            "late": lambda c: c not in edges,
        }[kind]
        places = [T.StructField(c, _KINDS[c]) for c in ("batch_id", *_PLACES[kind])]
        schema = T.StructType([f for f in state.struct if chosen(f.name)] + places)
        stored = self.spark.read.schema(schema).option("basePath", folder).parquet(*paths)
        if buckets is not None:
            stored = stored.filter(F.col(_BUCKET).isin(list(buckets)))
        if open_only:
            stored = stored.filter(F.col(_OPEN))
        if months is not None:
            stored = stored.filter(F.col(_MONTH).isin(list(months)))
        return stored.drop(*[f.name for f in places])

    def _append(self, df: DataFrame, kind: str, state: State, number: int) -> None:
        """Adds the rows of a batch to their folders, in place of what a run that died has left there."""
        v, path = self.v, self._folder(kind, state.generation)
        remove_folder(self.spark, f"{path}/batch_id={number}")
        made = {
            _OPEN: lambda: F.col(v.end).isNull(),
            _BUCKET: lambda: self._bucket(state),
            _MONTH: lambda: self._month(v.ts),
        }
        places = _PLACES[kind]
        df = df.withColumns({c: made[c]() for c in places})
        if places:
            # Rows of a folder come together; within it they lie by key.
            df = df.hint("rebalance", *places).sortWithinPartitions(*places, v.key)
        append_batch(df, path, number, within=places)

    def _open(self, keys: DataFrame | None = None, state: State | None = None, months: Sequence[str] | None = None) -> DataFrame:
        v, state = self.v, state or self.state()
        if state.batch_id < 0:
            raise LookupError(f"{self.path}: no batch yet")
        buckets = None
        if keys is not None:
            # One number per bucket at most.
            buckets = sorted(r["b"] for r in keys.select(self._bucket(state).alias("b")).distinct().collect())
        rows = self._committed("versions", state, buckets, open_only=True, months=months).filter(F.col(v.end).isNull())
        ended = self._committed("closures", state, buckets)
        if keys is not None:
            # A batch touches few keys: the table is then filtered where it is read.
            keys = small(keys)
            rows = join_null_safe(rows, keys, [v.key], "left_semi")
            ended = None if ended is None else join_null_safe(ended, keys, [v.key], "left_semi")
        if ended is None:
            return rows
        ended = ended.select(v.key, v.start)
        return join_null_safe(rows, ended if keys is not None else small(ended), [v.key, v.start], "left_anti")

    def current(self, months: Sequence[str] | None = None) -> DataFrame:
        """The current rows, or those of some months (``yyyy-MM`` of their event time)."""
        return self._open(months=months)

    def history(self) -> DataFrame:
        """Every version, with the ends that later batches set."""
        v, state = self.v, self.state()
        rows, ended = self._committed("versions", state), self._committed("closures", state)
        if ended is None:
            return rows
        closing = ended.select(v.key, v.start, F.col(v.end).alias("__end"))
        return (
            join_null_safe(rows, closing, [v.key, v.start], "left")
            .withColumn(v.end, F.coalesce(v.end, "__end"))
            .withColumn(v.flag, F.col(v.end).isNull())
            .select(*rows.columns)
        )

    def late(self) -> DataFrame | None:
        """Rows older than the version they would follow; None while there are none."""
        return self._committed("late", self.state())

    def apply(
        self, batch: DataFrame, mark: dt.datetime | None = None, hot_rows: int = HOT_ROWS, progress: str | None = None
    ) -> int:
        """Adds a batch and returns its number; ``mark`` and ``progress`` are stored with the commit.

        The batch is read several times (hot keys, history, late rows), so it is kept.
        """
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return self._apply(batch, mark, hot_rows, progress)
        finally:
            batch.unpersist()

    def _apply(self, batch: DataFrame, mark: dt.datetime | None, hot_rows: int, progress: str | None) -> int:
        v, state = self.v, self.state()
        state = state._replace(buckets=state.buckets or self.buckets)
        number = state.batch_id + 1
        if state.batch_id < 0:
            # No current rows yet: the history of the batch is the table.
            versions, late = advance(scd2_init(batch, v).limit(0), batch, v, hot_rows)
        else:
            touched = self._open(batch.select(v.key).distinct(), state)
            versions, late = advance(touched, batch, v, hot_rows)
        versions = versions.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            seed = F.col(SEED)
            self._append(versions.filter(~seed).drop(SEED), "versions", state, number)
            ended = versions.filter(seed & F.col(v.end).isNotNull()).select(v.key, v.start, v.end)
            self._append(ended, "closures", state, number)
            self._append(late, "late", state, number)
            # A seed stands for a version of the month it started in.
            changed = versions.filter(~seed | F.col(v.end).isNotNull()).select(self._month(v.ts).alias("m")).distinct()
            months = sorted(r["m"] for r in changed.collect())
        finally:
            versions.unpersist()
        schema = versions.drop(SEED).schema
        if state.schema:
            schema = evolve_schema(state.struct, schema)
        self._commit(State(number, state.generation, mark, schema.json(), progress, state.buckets, months))
        return number

    def fold(self) -> None:
        """Rewrites the history with its closures merged in, as a new generation."""
        state = self.state()
        folded = state._replace(batch_id=state.batch_id + 1, generation=state.generation + 1, months=[])
        self._append(self.history(), "versions", folded, folded.batch_id)
        late = self.late()
        if late is not None:
            self._append(late, "late", folded, folded.batch_id)
        self._commit(folded)

    def prune(self) -> None:
        """Removes the generations before the present one; call it when no reader is left on them."""
        for old in range(self.state().generation):
            for kind in ("versions", "closures", "late"):
                remove_folder(self.spark, self._folder(kind, old))
