"""File layout: even sizes, clustering on several columns at once, and packing of small files."""

from __future__ import annotations

import math
import sys
import uuid
from collections.abc import Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.sizes import small
from tidemark.session import has_rows_stored, move_file, remove_file, remove_folder, subfolders

# The placing of rows travels with its function: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows a file of a clustered frame should hold, and bytes a file of a compacted table.
ROWS_PER_FILE = 2_000_000
TARGET_BYTES = 256 << 20
#: Files below this share of the target are small.
SMALL_SHARE = 0.5
#: Sampled rows at least, and per file. Edges are learned from them; all rows are placed.
SAMPLE_ROWS, SAMPLE_PER_FILE = 20_000, 20
#: Of a text key the sample keeps so many characters; rows are compared with their whole texts.
_EDGE_CHARS = 1_024
_PARTED = "\x1f"


def rebalanced(df: DataFrame) -> DataFrame:
    """Partitions of the advisory size; a hot value is split, small ones are merged."""
    return df.hint("rebalance")


# --- clustering -----------------------------------------------------------------------


class _Places(NamedTuple):
    """Where rows go: edges of every column's ranks, bits of a rank, and the files of every partition value.

    ``files`` gives per value the number of its first file and the curve values that end all its files but the last.
    """

    edges: list[np.ndarray]
    bits: int
    files: dict[str, tuple[int, np.ndarray]]


def _values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values that are not null, where they are)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.drop_null().to_numpy(zero_copy_only=False), np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))


def _curve(columns: Sequence[pa.Array], edges: Sequence[np.ndarray], bits: int) -> np.ndarray:
    """Interleaved bits of the ranks of a row's keys: near rows get near values. A null has the first rank."""
    z = np.zeros(len(columns[0]), np.int64)
    for place, (column, marks) in enumerate(zip(columns, edges, strict=True)):
        values, at = _values(column)
        rank = np.zeros(len(z), np.int64)
        rank[at] = np.searchsorted(marks, values, "right")
        for i in range(bits):
            z |= ((rank >> i) & 1) << (i * len(columns) + place)
    return z


def _edges(column: pa.Array, bits: int) -> np.ndarray:
    """Values that cut the sample into 2^bits equal parts; a frequent value cuts once."""
    values, _ = _values(column)
    if values.dtype.kind == "f":
        values = values[~np.isnan(values)]
    values = np.sort(values)
    cuts = [i * len(values) >> bits for i in range(1, 1 << bits)] if len(values) else []
    return np.unique(values[cuts])


def _key(df: DataFrame, c: str) -> Column:
    """A column that orders as ``c`` and has a plain type."""
    kind = df.schema[c].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(c).cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(c)
    if isinstance(kind, T.BooleanType):
        return F.col(c).cast("int")
    if isinstance(kind, T.DecimalType):
        return F.col(c).cast("double")
    if isinstance(kind, T.BinaryType):
        return F.hex(c)
    if not isinstance(kind, (T.StringType, T.NumericType)):
        raise ValueError(f"{c}: no order to cluster by")
    return F.col(c)


def _part(parts: Sequence[str]) -> Column:
    """One text per combination of partition values."""
    return F.concat_ws(_PARTED, F.lit(""), *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in parts])


def _learn(df: DataFrame, cols: Sequence[str], parts: Sequence[str], rows: Mapping[str, int], files: Mapping[str, int]) -> _Places:
    """Edges of ranks and files from one sample of the keys, whose size follows the number of files."""
    total = sum(files.values())
    bits = min(62 // len(cols), max(1, math.ceil(math.log2(4 * total) / len(cols))))
    wanted = max(SAMPLE_ROWS, SAMPLE_PER_FILE * total)
    clipped = [
        (F.substring(k, 1, _EDGE_CHARS) if isinstance(df.schema[c].dataType, T.StringType) else k).alias(f"k{i}")
        for i, (c, k) in enumerate((c, _key(df, c)) for c in cols)
    ]
    share = min(1.0, wanted / max(1, sum(rows.values())))
    sample = df.select(*clipped, _part(parts).alias("part")).sample(share, 42).toArrow()
    columns = [sample.column(f"k{i}") for i in range(len(cols))]
    edges = [_edges(c, bits) for c in columns]
    z = _curve([c.combine_chunks() for c in columns], edges, bits)
    names = np.array(sample.column("part").to_pylist(), object)
    places, base = {}, 0
    for part, n in sorted(files.items()):
        own = np.sort(z[names == part]) if len(files) > 1 else np.sort(z)
        places[part] = (base, own[[i * len(own) // n for i in range(1, n)]] if len(own) else np.zeros(n - 1, np.int64))
        base += n
    return _Places(edges, bits, places)


def _place(places: _Places, columns: Sequence[pa.Array], parts: pa.Array, spread: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(curve value, file) of rows. A curve value that ends several files is spread over them by ``spread``."""
    z = _curve(columns, places.edges, places.bits)
    file = np.zeros(len(z), np.int32)
    coded = parts.dictionary_encode()
    number = coded.indices.to_numpy()
    for i, part in enumerate(coded.dictionary.to_pylist()):
        at = np.flatnonzero(number == i)
        base, cuts = places.files.get(part, (0, np.zeros(0, np.int64)))
        low, high = np.searchsorted(cuts, z[at], "left"), np.searchsorted(cuts, z[at], "right")
        file[at] = base + low + spread[at] % (high - low + 1)
    return z, file


def clustered(
    df: DataFrame, cols: Sequence[str], parts: Sequence[str] = (), files: Mapping[str, int] | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> DataFrame:
    """Rows placed along the Z curve of the columns' ranks, one range of it per file, in curve order.

    Ranks come from edges between whole keys, so a long common prefix or middle takes nothing from them; there are
    as many as the number of files needs. That number follows the row count; without ``parts`` it is at least
    ``spark.sql.shuffle.partitions``. No file spans two values of ``parts``, the partition columns of the target;
    ``files`` gives the numbers of their files if they are known (by :func:`part_key`).

    The frame is counted, its keys are sampled once, and it is shuffled once: file numbers are partitions.
    """
    part = _part(parts)
    if parts:
        rows = {r["part"]: r["count"] for r in df.groupBy(part.alias("part")).count().collect()}  # one per folder
    else:
        rows = {"": df.count()}
    if files is None:
        files = {p: max(1, -(-n // rows_per_file)) for p, n in rows.items()}
        if not parts:
            files[""] = max(files[""], int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    files = {p: files.get(p, 1) for p in rows} or {"": 1}
    places = _learn(df, cols, parts, rows, files)

    @F.arrow_udf("struct<z: bigint, file: int>")
    def place(parts: pa.Array, spread: pa.Array, *keys: pa.Array) -> pa.Array:
        z, file = _place(places, keys, parts, spread.to_numpy())
        return pa.StructArray.from_arrays([pa.array(z, pa.int64()), pa.array(file, pa.int32())], names=["z", "file"])

    spread = F.pmod(F.xxhash64(*df.columns), F.lit(1 << 31))
    placed = df.withColumn("__place", place(part, spread, *[_key(df, c) for c in cols]))
    total = sum(files.values())
    return placed.repartitionById(total, F.col("__place.file")).sortWithinPartitions("__place.z").drop("__place")


def part_key(*values: object) -> str:
    """The name :func:`clustered` gives to a combination of partition values, as texts."""
    return _PARTED.join(["", *["\x00" if v is None else str(v) for v in values]])


# --- compaction -----------------------------------------------------------------------

_STAGED = "_compact-"


def _stored_files(chosen: DataFrame, parts: Sequence[str]) -> DataFrame:
    """(path, bytes, rows, part) of the files behind a filtered scan; no data column is read."""
    meta = F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")
    return chosen.select(*meta, _part(parts).alias("part")).groupBy("path", "bytes", "part").agg(F.count(F.lit(1)).alias("rows"))


def pack_files(files: Sequence[tuple[str, int]], target: int) -> list[list[str]]:
    """Bins of at most ``target`` bytes, filled one after another from the largest file down."""
    bins: list[list[str]] = []
    held = target
    for path, size in sorted(files, key=lambda f: (-f[1], f[0])):
        if held + size > target:
            bins.append([])
            held = 0
        bins[-1].append(path)
        held += size
    return bins


def compact(
    spark: SparkSession, path: str, where: Mapping[str, object] | None = None, cluster_by: Sequence[str] = (),
    target: int = TARGET_BYTES,
) -> dict[str, int]:
    """Rewrites a partitioned table, or the partitions in ``where``, with files of about ``target`` bytes.

    Without ``cluster_by`` only small files are read, and packed into bins partition by partition; large ones, and
    a small one that meets no other, stay as they are. With it, all files of the chosen partitions are replaced by
    clustered ones. New files are written once, beside the table, and then take the place of the old ones; a run that
    dies meanwhile is finished by the next one.
    """
    path = path.rstrip("/")
    finish(spark, path)
    table = spark.read.parquet(path)
    parts = _partition_columns(spark, path)
    where = dict(where or {})
    unknown = set(where) - set(parts)
    if unknown:
        raise ValueError(f"not partition columns: {sorted(unknown)}")
    chosen = table
    for c, value in where.items():
        chosen = chosen.filter(F.col(c) == F.lit(value))
    # One row per file, as the listing of the table itself holds.
    found = [tuple(r) for r in _stored_files(chosen, parts).select("path", "bytes", "part").collect()]
    if cluster_by:
        old = [f for f, *_ in found]
        sizes: dict[str, int] = {}
        for _, size, part in found:
            sizes[part] = sizes.get(part, 0) + size
        files = {p: max(1, round(n / target)) for p, n in sizes.items()}
        placed = clustered(chosen, cluster_by, parts, files) if old else None
    else:
        old, placed = _packed(chosen, found, target)
    if placed is None:
        return {"files_before": len(found), "files_after": len(found)}
    staged = f"{path}/{_STAGED}{uuid.uuid4().hex}"
    writer = placed.write.mode("overwrite")
    (writer.partitionBy(*parts) if parts else writer).parquet(f"{staged}/new")
    # The list makes the exchange repeatable: from here on a run that dies can be finished.
    spark.createDataFrame([(f,) for f in old], "path string").coalesce(1).write.mode("overwrite").parquet(f"{staged}/old")
    made = finish(spark, path)
    return {"files_before": len(found), "files_after": len(found) - len(old) + made}


def _packed(chosen: DataFrame, found: Sequence[tuple[str, int, str]], target: int) -> tuple[list[str], DataFrame | None]:
    """(small files, their rows with a bin as a partition); bins with one file are left out."""
    by_part: dict[str, list[tuple[str, int]]] = {}
    for path, size, part in found:
        if size < SMALL_SHARE * target:
            by_part.setdefault(part, []).append((path, size))
    bins = [b for _, files in sorted(by_part.items()) for b in pack_files(files, target) if len(b) > 1]
    if not bins:
        return [], None
    spark = chosen.sparkSession
    named = [(path, i) for i, names in enumerate(bins) for path in names]
    numbers = small(spark.createDataFrame(named, "__path string, __bin int"))
    rows = chosen.withColumn("__path", F.col("_metadata.file_path")).join(numbers, "__path")
    return [p for p, _ in named], rows.repartitionById(len(bins), F.col("__bin")).drop("__path", "__bin")


def finish(spark: SparkSession, path: str) -> int:
    """Ends exchanges of files that were staged in full, drops others; returns the number of files that came in.

    Old files go first, so no row is ever read twice; a reader meanwhile may miss rows that are staged.
    """
    made = 0
    for name in [f for f in subfolders(spark, path) if f.startswith(_STAGED)]:
        staged = f"{path}/{name}"
        # The list is one file, so it is there in full or not at all.
        if has_rows_stored(spark, f"{staged}/old"):
            for r in spark.read.schema("path string").parquet(f"{staged}/old").collect():
                remove_file(spark, r["path"])
            if has_rows_stored(spark, f"{staged}/new"):
                new = spark.read.parquet(f"{staged}/new").select(F.col("_metadata.file_path").alias("path")).distinct()
                for r in new.collect():
                    move_file(spark, r["path"], path, r["path"].split(f"/{name}/new/", 1)[1])
                    made += 1
        remove_folder(spark, staged)
    return made


def _partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Partition columns of a parquet folder: those no data file holds itself."""
    stored = set(spark.read.option("recursiveFileLookup", "true").parquet(path).columns)
    return [c for c in spark.read.parquet(path).columns if c not in stored]
