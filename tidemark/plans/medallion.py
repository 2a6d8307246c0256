"""The whole run: raw files to bronze, silver, gold, quality gate and churn scores."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import values as V
from tidemark.operators import churn, gold, quality, rules
from tidemark.operators.relational import dedup_by_ingestion, enforced, union_sources
from tidemark.operators.silver import SILVER_VERSIONS, cleanse
from tidemark.plans.maintenance import maintain
from tidemark.session import has_rows_stored
from tidemark.sources import files, sinks
from tidemark.sources.versions import BUCKETS, VersionStore
from tidemark.streaming.ingest import run_ingest

# Batch number of a first load; stream batches count from 0.
_BACKFILL = -1


@dataclass(frozen=True)
class Feed:
    """One raw folder."""

    name: str
    path: str
    fmt: str = "json"
    tag: str | None = None
    strict: bool = True
    #: Raw files a micro-batch takes, which bounds what is kept for its two writes.
    files_per_batch: int = 1_000


@dataclass
class Report:
    batches: list[dict] = field(default_factory=list)
    silver_batch: int | None = None
    quality: DataFrame | None = None


def months_before(ref: str, days: int) -> list[str]:
    """The months (``yyyy-MM``) of the ``days`` before ``ref`` and of that day."""
    last = dt.date.fromisoformat(ref)
    first = last - dt.timedelta(days)
    span = range(first.year * 12 + first.month - 1, last.year * 12 + last.month)
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in span]


class Lakehouse:
    """Name to path, and one method per stage. Times come in as parameters."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def table(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, name))

    def bronze(self, feed: str) -> DataFrame:
        """A bronze table under its stored schema: no file is opened to find the columns."""
        schema = self._schemas(f"{feed}_table").get("_source_file string")
        return self.spark.read.schema(schema).parquet(self.path("bronze", feed))

    def _schemas(self, name: str) -> files.SchemaStore:
        return files.SchemaStore(self.spark, self.path("control", f"schemas/{name}"))

    @property
    def silver(self) -> VersionStore:
        return VersionStore(self.spark, self.path("silver", "transacoes"), SILVER_VERSIONS, self.buckets)

    # --- bronze ---

    def ingest(self, feed: Feed, schema: str = V.RAW_SCHEMA) -> list[dict]:
        """New files of a feed into its bronze table and its quarantine.

        JSON is read as text: values of a wrong type and fields the schema does not have yet are rescued, lines
        that are no object are kept as they are, in both tables.
        """
        grown = self._grown_schema(feed, schema)
        if feed.fmt == "json":
            lines = files.stream_files(self.spark, feed.path, "text", "value string", feed.files_per_batch)
            lines = files.with_lineage(lines.filter(F.trim("value") != ""), feed.tag)
            stream = files.with_rescue(lines, grown)
        else:
            raw = files.stream_files(self.spark, feed.path, feed.fmt, grown, feed.files_per_batch)
            stream = files.with_lineage(raw, feed.tag)
        self._schemas(f"{feed.name}_table").evolve("", stream.schema)
        return run_ingest(
            stream,
            rules.ingest_rules() if feed.strict else rules.presence_rules(),
            self.path("bronze", feed.name),
            self.path("bronze", f"{feed.name}_quarantine"),
            self.path("checkpoints", feed.name),
        )

    def _grown_schema(self, feed: Feed, schema: str) -> T.StructType:
        """The schema with the fields of new files.

        Only files changed since the last look are opened: of JSON files their lines (a field missed so is rescued),
        of others the footers.
        """
        store = self._schemas(feed.name)
        if not has_rows_stored(self.spark, feed.path):
            return store.get(schema)
        marks = files.HighWater(self.spark, self.path("control", "marks"))
        job = f"schema:{feed.name}"
        seen, newest = marks.get(job), files.newest_file(self.spark, feed.path)
        if newest is None or (seen is not None and newest <= seen):
            return store.get(schema)
        # File times are coarse: the last second is looked at twice.
        since = seen - dt.timedelta(seconds=1) if seen else None
        grown = store.evolve(schema, files.infer(self.spark, feed.path, feed.fmt, since))
        marks.advance(job, newest)
        return grown

    def backfill(self, feed: Feed, history: DataFrame, system: str) -> bool:
        """Loads history once into its own batch, under the number no stream batch has."""
        marks = files.HighWater(self.spark, self.path("control", "marks"))
        job = f"backfill:{feed.name}"
        if marks.get(job) is not None:
            return False
        loaded = files.with_lineage(history, feed.tag, system)
        self._schemas(f"{feed.name}_table").evolve("", loaded.schema)
        sinks.append_batch(loaded, self.path("bronze", feed.name), _BACKFILL)
        marks.advance(job, dt.datetime(1970, 1, 1))
        return True

    # --- silver ---

    def refine(self, feeds: Sequence[str], at: dt.datetime | None = None) -> int | None:
        """The bronze batches not refined yet, into the history.

        Which batches went in is part of the same commit, so a run that dies is repeated
        and one that ended is not. Older batches are pruned by their partition.
        """
        store = self.silver
        done = {f: set(ids) for f, ids in json.loads(store.state().progress or "{}").items()}
        fresh = []
        for feed in feeds:
            last = max(done.get(feed, ()), default=_BACKFILL)
            stored = sinks.batch_ids(self.spark, self.path("bronze", feed))
            new = [b for b in stored if b > last or (b == _BACKFILL and b not in done.get(feed, ()))]
            if not new:
                continue
            chosen = F.col("batch_id") > last
            if _BACKFILL in new:
                chosen = chosen | (F.col("batch_id") == _BACKFILL)
            fresh.append(self.bronze(feed).filter(chosen & (F.col("batch_id") <= max(new))).drop("batch_id", files.RESCUE, files.CORRUPT))
            # Batches go in whole and in order: the largest stands for all before it.
            kept = {max(new)} | ({_BACKFILL} & (done.get(feed, set()) | set(new)))
            done[feed] = kept
        if not fresh:
            return None
        batch = cleanse(dedup_by_ingestion(union_sources(*fresh)))
        return store.apply(batch, at, progress=json.dumps({f: sorted(ids) for f, ids in done.items()}))

    # --- gold ---

    def build_gold(self, ref: str, full: bool = False) -> None:
        """Revenue (the day of ``ref``, or all days), RFM of ``ref``, all KPI months.

        The day and the RFM year open the months they need only.
        """
        current = gold.approved(self.silver.current())
        day, year = [gold.approved(self.silver.current(months_before(ref, n))) for n in (0, gold.RFM_DAYS)]
        revenue = gold.daily_revenue(current if full else day)
        target = self.path("gold", "receita_diaria")
        if full:
            sinks.overwrite(revenue, target, ["dt_ref"])
        else:
            sinks.replace_slice(revenue, target, "dt_ref", ref)
        rfm = enforced(gold.rfm(year, ref), V.RFM_SCHEMA)
        sinks.replace_slice(rfm, self.path("gold", "rfm_clientes"), "dt_calculo", ref)
        sinks.overwrite(gold.kpis_of(self.monthly_totals(full), ref), self.path("gold", "kpis_executivos"))

    def monthly_totals(self, full: bool = False) -> DataFrame:
        """The stored totals of every month, after renewing those that batches have changed since.

        Totals that cannot be added, as distinct customers, come from the current rows of their month; other months
        are not opened. ``full`` renews all.
        """
        path, parts = self.path("gold", "totais_mensais"), ["ano_transacao", "mes_transacao"]
        batch = self.silver.state().batch_id
        stored = has_rows_stored(self.spark, path)
        # Every row names the batch it was renewed after.
        done = -1 if full or not stored else self.spark.read.parquet(path).agg(F.max("lote")).first()[0]
        months = self.silver.touched_months(done)
        if done < 0 or months:
            current = self.silver.current(None if done < 0 else months)
            totals = gold.monthly_totals(gold.approved(current)).withColumn("lote", F.lit(batch).cast("long"))
            if done < 0:
                sinks.overwrite(totals, path, parts)
            else:
                sinks.replace_folders(totals, path, parts, [(int(m[:4]), int(m[5:])) for m in months if m != "none"])
            if not has_rows_stored(self.spark, path):
                return totals.drop("lote").limit(0)
        return self.spark.read.parquet(path).drop("lote")

    def rfm(self, ref: str) -> DataFrame:
        return self.table("gold", "rfm_clientes").filter(F.col("dt_calculo") == F.lit(ref).cast("date"))

    def maintain(self) -> dict[str, dict[str, int]]:
        """Merges the ends into the history and evens out the gold files.

        Every gold table and check reads the current rows; after this they need no join.
        """
        self.silver.fold()
        return maintain(self.spark, f"{self.root}/gold")

    # --- quality ---

    def check(self, ref: str, at: dt.datetime, threshold: float = 95.0) -> DataFrame:
        """Runs both suites, logs a row for each, and raises below the threshold."""
        silver = quality.run_suite(self.silver.current(), quality.silver_suite(ref))
        rfm = quality.run_suite(self.rfm(ref), quality.rfm_suite())
        log = quality.summarise(silver, "silver.transacoes", threshold, at).unionByName(
            quality.summarise(rfm, "gold.rfm_clientes", threshold, at)
        )
        rows = self.spark.createDataFrame(log.collect(), log.schema)  # one row per table
        sinks.append_results(rows, self.path("data_quality", "dq_resultados"))
        quality.gate(rows)
        return rows

    # --- churn ---

    def train(
        self, ref: str, at: dt.datetime, space: churn.Space = churn.Space(), trials: int = 30, forward_days: int | None = 30,
        min_auc: float = 0.75,
    ) -> DataFrame:
        """Search, final fit, registration and promotion; returns the registry.

        Features are those known ``forward_days`` before ``ref``, the label tells who bought in these days. With
        ``None`` both come from the RFM slice of ``ref``, as in the published table, where the label is a function
        of a feature.
        """
        if forward_days is None:
            features = churn.churn_features(self.rfm(ref))
        else:
            cutoff = (dt.date.fromisoformat(ref) - dt.timedelta(forward_days)).isoformat()
            sales = gold.approved(self.silver.current(months_before(ref, forward_days + churn.HISTORY_DAYS)))
            features = churn.forward_features(sales, cutoff, forward_days)
        parts = churn.stratified_split(features, {"train": 0.68, "val": 0.12, "test": 0.2})
        sinks.overwrite(parts, self.path("ml", "features"), ["part"])
        part = lambda p: self.table("ml", "features").filter(F.col("part") == p).drop("part")
        params, log = churn.parzen_search(part("train"), part("val"), space, trials)
        sinks.append_results(log.withColumn("dt_execucao", F.lit(at)), self.path("ml", "trials"))
        model, measured = churn.fit_final(part("train"), part("val"), part("test"), params)
        known = self.registry()
        version = 1 + ((known.agg(F.max("version")).first()[0] or 0) if known is not None else 0)
        row = churn.register(
            self.spark, model, self.path("ml", f"models/{version}"), "churn_predictor", version,
            measured.first()["auc"], at, part("test"),
        )
        self._enter(row)
        staged, before = churn.with_stages(self.registry(), min_auc), self.registry()
        # Versions whose stage has changed get a new entry.
        self._enter(staged.join(before.select("name", "version", F.col("stage").alias("__was")), ["name", "version"])
                    .filter("stage <> __was").drop("__was"))
        return self.registry()

    def _enter(self, rows: DataFrame) -> None:
        """Appends entries to the registry; entries are numbered, so the last one of a version counts."""
        path = self.path("ml", "registry")
        last = self.spark.read.parquet(path).agg(F.max("entry")).first()[0] if has_rows_stored(self.spark, path) else 0
        kept = self.spark.createDataFrame(rows.select(*churn.REGISTRY_COLUMNS).collect(), churn.REGISTRY_SCHEMA)  # some rows
        sinks.append_results(kept.withColumn("entry", F.lit(last + 1)), path)

    def registry(self) -> DataFrame | None:
        """One row per model version with its stage; None before the first."""
        path = self.path("ml", "registry")
        return churn.latest_stages(self.spark.read.parquet(path)) if has_rows_stored(self.spark, path) else None

    def run(self, feeds: Sequence[Feed], ref: str, at: dt.datetime, threshold: float = 95.0, full: bool = False) -> Report:
        """All stages in order. Raises at the gate; training is a separate step behind it."""
        report = Report()
        for feed in feeds:
            report.batches += self.ingest(feed)
        report.silver_batch = self.refine([f.name for f in feeds], at)
        self.build_gold(ref, full)
        report.quality = self.check(ref, at, threshold)
        return report
