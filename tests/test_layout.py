"""Clustering on whole keys, and compaction that leaves large files alone."""

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import layout
from tidemark.session import run_dir


def spans(df, *cols):
    """(file, rows, least and largest value of each column)."""
    placed = df.withColumn("f", F.spark_partition_id())
    bounds = [f(F.col(c).cast("string")).alias(f"{c}{i}") for c in cols for i, f in enumerate((F.min, F.max))]
    return placed.groupBy("f").agg(F.count(F.lit(1)).alias("n"), *bounds).collect()


def share_read(found, c, values):
    """Mean share of the files whose span holds a value."""
    hit = [sum(r[f"{c}0"] <= v <= r[f"{c}1"] for r in found) for v in values]
    return sum(hit) / len(hit) / len(found)


def keyed(spark, n):
    """Ids with a long common prefix and middle, two texts and a number that are independent."""
    mixed = lambda seed, m: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(m)).cast("string")
    return spark.range(n).select(
        F.concat(F.lit("tenant-0001/region-eu-west-1/object-"), F.lpad(mixed(1, 5000), 8, "0"), F.lit("-v1")).alias("a"),
        F.lpad(mixed(2, 4000), 6, "0").alias("b"), "id",
    )


def test_files_read_by_a_point_filter_fall_with_size(spark):
    df = keyed(spark, 40_000).cache()
    a = [r["a"] for r in df.limit(30).collect()]
    b = [r["b"] for r in df.limit(30).collect()]
    shares = []
    for files in (8, 32, 128):
        found = spans(layout.clustered(df, ["a", "b"], rows_per_file=-(-40_000 // files)), "a", "b")
        assert len(found) == files and max(r["n"] for r in found) < 2.5 * 40_000 / files
        shares.append((share_read(found, "a", a), share_read(found, "b", b)))
    # About one in the root of the number of files, for either key.
    assert all(s < 2.2 / files ** 0.5 for files, pair in zip((8, 32, 128), shares, strict=True) for s in pair)
    assert shares[0] > shares[1] > shares[2]
    assert rows(layout.clustered(df, ["a", "b"]), "id") == rows(df, "id")


def test_nulls_types_and_hot_values(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 7 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("s"),
        F.when(F.col("id") % 5 > 0, F.col("id").cast("double")).alias("d"),
        F.timestamp_micros(F.col("id") * 10**9).alias("t"), (F.col("id") % 2 == 0).alias("flag"),
        F.col("id").cast("decimal(20,2)").alias("m"), F.col("id").cast("string").cast("binary").alias("raw"),
        (F.lit(2**62) + F.col("id")).alias("big"), F.when(F.col("id") % 3 == 0, F.lit(float("nan"))).alias("nan"), "id",
    )
    for cols in (["s"], ["d", "nan"], ["t", "flag", "m"], ["raw", "big"]):
        placed = layout.clustered(df, cols, rows_per_file=300)
        assert rows(placed, "id") == rows(df, "id")
        assert max(r["n"] for r in spans(placed)) < 900
    # Neighbours beyond 2^53 are told apart.
    found = spans(layout.clustered(df, ["big"], rows_per_file=300), "big")
    assert share_read(found, "big", [str(2**62 + i) for i in range(5, 3000, 211)]) < 2.1 / len(found)
    assert layout.clustered(df.limit(0), ["s"]).count() == 0
    with pytest.raises(ValueError):
        layout.clustered(df.withColumn("x", F.array("id")), ["x"])


def stored(spark, folder):
    return {
        os.path.basename(r["f"]): r["n"]
        for r in spark.read.parquet(folder).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count("*").alias("n")).collect()
    }


def test_large_files_stay(spark):
    path = run_dir(spark, "packed")
    df = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x"), F.lit("a b/c").alias("p"))
    df.where("id < 40000").coalesce(1).write.partitionBy("p").parquet(path)
    large = stored(spark, path)
    df.where("id >= 40000").repartition(10).write.mode("append").partitionBy("p").parquet(path)
    size = max(r[0] for r in spark.read.parquet(path).select("_metadata.file_size").distinct().collect())
    report = layout.compact(spark, path, target=int(size * 1.2))
    after = stored(spark, path)
    assert report == {"files_before": 11, "files_after": len(after)} and len(after) == 2
    assert large.items() <= after.items()
    assert rows(spark.read.parquet(path), "id", "p") == rows(df, "id", "p")
    # Nothing is left to pack.
    assert layout.compact(spark, path, target=int(size * 1.2)) == {"files_before": 2, "files_after": 2}
    assert stored(spark, path) == after and not [f for f in session.subfolders(spark, path) if f.startswith("_compact")]


def test_spans_after_compaction_are_those_of_the_clustered_frame(spark):
    path = run_dir(spark, "spans")
    df = keyed(spark, 20_000).withColumn("p", F.when(F.col("id") % 4 > 0, "x")).cache()
    df.repartition(6).write.partitionBy("p").parquet(path)
    bytes_of = {r["p"]: r["b"] for r in spark.read.parquet(path).select("p", "_metadata.file_path", "_metadata.file_size")
                .distinct().groupBy("p").agg(F.sum("file_size").alias("b")).collect()}
    target = max(bytes_of.values()) // 9
    files = {layout.part_key(p): max(1, round(b / target)) for p, b in bytes_of.items()}
    layout.compact(spark, path, cluster_by=["a", "b"], target=target)
    table = spark.read.parquet(path)
    bounds = [f(c).alias(f"{c}{i}") for c in ("a", "b") for i, f in enumerate((F.min, F.max))]
    got = sorted(tuple(r)[1:] for r in table.groupBy("_metadata.file_path").agg(*bounds).collect())
    fresh = spark.read.parquet(path)
    want = layout.clustered(fresh, ["a", "b"], ["p"], files).groupBy(F.spark_partition_id()).agg(*bounds)
    assert len(got) == sum(files.values())
    # The sample of the second run differs, so spans are held by their widths.
    width = lambda found, i: sum(r[i + 1] != r[i] and share([r], i, found) for r in found) / len(found)
    share = lambda one, i, found: sum(o[i] <= one[0][i] <= o[i + 1] for o in found) / len(found)
    again = sorted(tuple(r)[1:] for r in want.collect())
    for i in (0, 2):
        assert abs(width(got, i) - width(again, i)) < 0.15 and width(got, i) < 0.75
    assert rows(table, "id", "p") == rows(df, "id", "p")


def test_an_exchange_that_died_is_finished(spark, monkeypatch):
    path = run_dir(spark, "died")
    df = spark.range(900).select("id", (F.col("id") % 2).alias("p"))
    df.repartition(5).write.partitionBy("p").parquet(path)
    moved = []

    def dies(spark, uri, folder, inside):
        if moved:
            raise OSError("lost")
        moved.append(inside)
        session.move_file(spark, uri, folder, inside)

    monkeypatch.setattr(layout, "move_file", dies)
    with pytest.raises(OSError, match="lost"):
        layout.compact(spark, path)
    monkeypatch.undo()
    # Rows may be missing meanwhile, but none is there twice, and the next run brings them back.
    assert spark.read.parquet(path).groupBy("id").count().where("count > 1").isEmpty()
    layout.finish(spark, path)
    assert rows(spark.read.parquet(path), "id", "p") == rows(df, "id", "p")
    # A run that died before its list was written has exchanged nothing.
    df.write.parquet(f"{path}/_compact-early/new")
    layout.compact(spark, path)
    assert rows(spark.read.parquet(path), "id", "p") == rows(df, "id", "p")


def test_bins_are_filled():
    files = [(f"f{i}", s) for i, s in enumerate([5, 90, 30, 30, 40, 1, 99, 60])]
    bins = layout.pack_files(files, 100)
    assert sorted(f for b in bins for f in b) == sorted(f for f, _ in files)
    assert all(sum(dict(files)[f] for f in b) <= 100 for b in bins) and len(bins) <= 6
