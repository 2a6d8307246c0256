"""Incremental files, evolving schemas, rescued values and the high-water mark."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import has_rows_stored

CORRUPT = "_corrupt"
RESCUE = "_rescue"


def as_struct(schema: T.StructType | str) -> T.StructType:
    if isinstance(schema, str):
        return T.StructType.fromDDL(schema) if schema else T.StructType()
    return schema


def stream_files(
    spark: SparkSession, path: str, fmt: str, schema: T.StructType | str, files_per_batch: int | None = None, **options: str
) -> DataFrame:
    """Stream over the files of a folder; the checkpoint of its sink remembers those seen.

    Files that arrive late with an old date are taken too; by default they would be passed over.
    """
    reader = spark.readStream.format(fmt).schema(as_struct(schema)).options(**{"maxFileAge": "36500d", **options})
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def with_lineage(df: DataFrame, source: str | None = None, system: str | None = None) -> DataFrame:
    """Adds source file and ingestion time, and the source tag where one is given.

    ``system`` names the origin of rows that come from no file.
    """
    origin = F.lit(system) if system else F.col("_metadata.file_path")
    out = df.select("*", origin.alias("_source_file"), F.current_timestamp().alias("_ingestion_time"))
    return out.withColumn("_cloud_origem", F.lit(source)) if source else out


def evolve_schema(base: T.StructType | str, observed: T.StructType | str) -> T.StructType:
    """The base fields, then the fields only seen in the input. Base types win."""
    base, observed = as_struct(base), as_struct(observed)
    known = {f.name.lower() for f in base}
    new = [T.StructField(f.name, f.dataType, True) for f in observed if f.name.lower() not in known]
    return T.StructType([*base.fields, *new])


class SchemaStore:
    """Schemas of a feed, one JSON row per version."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def get(self, base: T.StructType | str) -> T.StructType:
        if not has_rows_stored(self.spark, self.path):
            return as_struct(base)
        latest = self.spark.read.parquet(self.path).agg(F.max_by("schema", "version")).first()[0]
        return T.StructType.fromJson(json.loads(latest)) if latest else as_struct(base)

    def evolve(self, base: T.StructType | str, observed: T.StructType | str) -> T.StructType:
        """Stores and returns the grown schema; unchanged schemas add no version."""
        old = self.get(base)
        new = evolve_schema(old, observed)
        if new != old or not self._stored():
            version = self._stored() + 1
            row = self.spark.createDataFrame([(version, new.json())], "version int, schema string")
            row.coalesce(1).write.mode("append").parquet(self.path)
        return new

    def _stored(self) -> int:
        if not has_rows_stored(self.spark, self.path):
            return 0
        return self.spark.read.parquet(self.path).agg(F.max("version")).first()[0] or 0


def newest_file(spark: SparkSession, path: str) -> dt.datetime | None:
    """Latest modification time in a folder; file contents are not read."""
    listed = spark.read.format("binaryFile").load(path)
    return listed.agg(F.max("modificationTime").alias("t")).first()["t"]


def infer_json(spark: SparkSession, path: str, since: dt.datetime | None = None) -> T.StructType:
    """Schema of the JSON files changed after ``since``, as Spark infers it on the executors."""
    return infer(spark, path, "json", since)


def infer(spark: SparkSession, path: str, fmt: str, since: dt.datetime | None = None) -> T.StructType:
    """All columns of the files changed after ``since``; no other file is opened."""
    reader = spark.read.format(fmt).option("mergeSchema", "true")
    if since is not None:
        stamp = since.astimezone(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")
        reader = reader.option("timeZone", "UTC").option("modifiedAfter", stamp)
    return reader.load(path).schema


def with_rescue(lines: DataFrame, schema: T.StructType | str, text: str = "value") -> DataFrame:
    """JSON lines as typed columns plus two for what does not fit.

    ``_rescue`` holds, as JSON, unknown fields and values that do not fit their type;
    ``_corrupt`` holds a line that is not one JSON object and nothing else.
    """
    schema = as_struct(schema)
    # Text behind the object would be dropped: the line is read as the first of two array items.
    items = F.from_json(
        F.concat(F.lit("["), F.col(text), F.lit(', {"__end": "1"}]')), T.ArrayType(T.MapType(T.StringType(), T.StringType()))
    )
    alone = (
        (F.size("__items") == 2) & F.get("__items", F.lit(1))["__end"].eqNullSafe("1")
        & F.get("__items", F.lit(0))["__end"].isNull()
    )
    raw: Column = F.when(F.coalesce(alone, F.lit(False)), F.get("__items", F.lit(0)))
    parsed = lines.withColumn("__items", items).withColumn("__raw", raw)
    parsed = parsed.withColumn("__typed", F.when(F.col("__raw").isNotNull(), F.from_json(text, schema)))
    names = [f.name for f in schema]
    misfits = [
        F.when(F.col(f"__typed.{n}").isNull() & F.col("__raw")[n].isNotNull(), F.lit(n)) for n in names
    ]
    known = F.array(*[F.lit(n) for n in names])
    # Most lines fit: what does not is named once per line, and fields are looked through only where there is something.
    parsed = parsed.withColumn("__bad", F.array_compact(F.array(*misfits)))
    unknown = F.size(F.array_except(F.map_keys("__raw"), known)) > 0
    kept = F.map_filter("__raw", lambda k, _: ~F.array_contains(known, k) | F.array_contains("__bad", k))
    others = [c for c in lines.columns if c != text]
    return parsed.select(
        *[F.col(f"__typed.{n}").alias(n) for n in names],
        *others,
        F.when(unknown | (F.size("__bad") > 0), F.to_json(kept)).alias(RESCUE),
        F.when(F.col("__raw").isNull() & F.col(text).isNotNull(), F.col(text)).alias(CORRUPT),
    )


class HighWater:
    """Up to where every job has read: an append-only table."""

    SCHEMA = "job string, mark timestamp"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def marks(self) -> DataFrame:
        if has_rows_stored(self.spark, self.path):
            stored = self.spark.read.schema(self.SCHEMA).parquet(self.path)
        else:
            stored = self.spark.createDataFrame([], self.SCHEMA)
        return stored.groupBy("job").agg(F.max("mark").alias("mark"))

    def get(self, job: str) -> dt.datetime | None:
        row = self.marks().filter(F.col("job") == job).first()
        return row["mark"] if row else None

    def advance(self, job: str, mark: dt.datetime) -> None:
        self.advance_all(self.spark.createDataFrame([(job, mark)], self.SCHEMA))

    def advance_all(self, marks: DataFrame) -> None:
        """Marks of several jobs, a row (job, mark) each; a lower mark than known has no effect."""
        rows = marks.select("job", F.col("mark").cast("timestamp").alias("mark"))
        rows.coalesce(1).write.mode("append").parquet(self.path)
