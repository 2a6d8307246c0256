"""Cases in which rows or values used to be lost: null times and keys, wrong types, new columns, empty slices."""

import datetime as dt
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_medallion import AT, tx, write
from test_scd import DDL, V, at, brute, same, skewed

from tidemark import session
from tidemark.operators import scd, sizes
from tidemark.operators.relational import join_null_safe
from tidemark.plans.medallion import Feed, Lakehouse
from tidemark.session import run_dir
from tidemark.sources import files, sinks
from tidemark.sources.versions import VersionStore


def test_rows_without_time_start_no_version(spark):
    store = VersionStore(spark, run_dir(spark, "nulltime"), V)
    store.apply(spark.createDataFrame([("a", "x", "p", at(0), 0), ("b", "x", "p", None, 1)], DDL))
    store.apply(spark.createDataFrame([("a", "y", "p", None, 2), ("a", "z", "p", at(5), 3), ("b", "y", "p", at(6), 4)], DDL))
    current = store.current()
    assert rows(current, "k", "a") == [("a", "z"), ("b", "y")]
    assert rows(store.history(), "k", "a", "is_current") == [("a", "x", False), ("a", "z", True), ("b", "y", True)]
    assert store.late().count() == 2


def test_null_keys_have_one_current_row(spark):
    store = VersionStore(spark, run_dir(spark, "nullkey"), V)
    store.apply(spark.createDataFrame([(None, "x", "p", at(0), 0)], DDL))
    store.apply(spark.createDataFrame([(None, "y", "p", at(1), 1)], DDL))
    assert rows(store.current(), "k", "a") == [(None, "y")]
    one = scd.scd2_init(spark.createDataFrame([(None, "x", "p", at(0), 0)], DDL), V)
    step = scd.scd2_apply(one, spark.createDataFrame([(None, "y", "p", at(1), 1)], DDL), V)
    assert rows(step.current, "a") == [("y",)] and step.closed.count() == 1


def test_hot_null_key_is_sliced(spark):
    data = [(None if r[0] == "hot" else r[0], *r[1:]) for r in skewed(seed=5)]
    df = spark.createDataFrame(data, DDL).repartition(4)
    assert None in scd.hot_keys(df, "k", 50)
    got = scd.scd2_history(df, V, hot_rows=50).filter("k is null").select("seq").collect()
    assert {r["seq"] for r in got} == {r[4] for r in brute([("n", *r[1:]) for r in data if r[0] is None])}


def test_the_hot_limit_is_the_same_for_every_size(spark, monkeypatch):
    monkeypatch.setattr(scd, "_BUCKETS", 1)
    df = spark.createDataFrame(skewed(seed=9), DDL)
    assert "hot" in scd.hot_keys(df, "k", 100)
    same(scd.scd2_history(df, V, hot_rows=100), brute(skewed(seed=9)))


def test_null_safe_join(spark):
    a = spark.createDataFrame([(1, "x"), (None, "y")], "k int, v string")
    b = spark.createDataFrame([(None, "z")], "k int, w string")
    assert rows(join_null_safe(a, b, ["k"], "inner"), "k", "v", "w") == [(None, "y", "z")]
    assert rows(join_null_safe(a, b, ["k"], "left_anti"), "v") == [("x",)]


def test_an_empty_slice_is_emptied(spark):
    path = run_dir(spark, "slices")
    df = spark.createDataFrame([(1, "a b"), (2, "b")], "n int, s string")
    sinks.overwrite(df, path, ["s"])
    sinks.replace_slice(df.filter("n = 2"), path, "s", "a b")
    assert rows(spark.read.parquet(path), "n") == [(2,)]
    days = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))], "n int, d date")
    path = run_dir(spark, "days")
    sinks.overwrite(days, path, ["d"])
    sinks.replace_slice(days.filter("n = 2"), path, "d", "2024-01-01")
    assert rows(spark.read.parquet(path), "n") == [(2,)]


@pytest.mark.parametrize("text", ['{"n":1}{"n":2}', '{"n":1} x', "[1]", "{", '{"n":1}, {"n":2}', ""])
def test_lines_that_are_not_one_object_are_kept_whole(spark, text):
    row = files.with_rescue(spark.createDataFrame([(text,)], "value string"), "n int").first()
    assert row["n"] is None and row["_corrupt"] == text and row["_rescue"] is None


def test_wrong_types_and_late_fields_survive_ingestion(spark):
    root = run_dir(spark, "lossless")
    raw = root + "/raw"
    write(raw, "1.json", [tx(1, 1, 5.0, "2024-01-01"), tx(2, 1, "12,50", "2024-01-01"), {**tx(3, 1, 5.0, "2024-01-01"), "dt_transacao": "31/01/2024"}])
    with open(raw + "/2.json", "w") as f:
        f.write('{"id_transacao": broken\n\n')
    lake = Lakehouse(spark, root)
    feed = Feed("azure", raw, tag="azure")
    lake.ingest(feed)
    # Older than what was seen, with a field nobody knows.
    write(raw, "0.json", [tx(4, 1, 5.0, "2024-01-01", novo_campo="kept")])
    os.utime(raw + "/0.json", (1_600_000_000, 1_600_000_000))
    lake.ingest(feed)
    kept, refused = lake.bronze("azure"), lake.table("bronze", "azure_quarantine")
    rescued = {r["id_transacao"]: r["_rescue"] or "" for r in kept.collect()}
    assert "31/01/2024" in rescued["t3"] and "novo_campo" in rescued["t4"] and not rescued["t1"]
    bad = {r["id_transacao"]: (r["_rescue"] or "", r["_corrupt"]) for r in refused.collect()}
    assert "12,50" in bad["t2"][0] and bad[None][1] == '{"id_transacao": broken'
    assert lake.refine(["azure"], AT) == 0
    assert {"_rescue", "_corrupt"}.isdisjoint(lake.silver.current().columns)
    assert rows(lake.silver.current(), "id_transacao") == [("t1",), ("t4",)]


def test_parquet_feeds_grow_columns(spark):
    root = run_dir(spark, "grow")
    raw = root + "/raw"
    base = spark.createDataFrame([("t1", "c", 1.0)], "id_transacao string, id_cliente string, valor double")
    base.write.mode("append").parquet(raw)
    lake = Lakehouse(spark, root)
    feed = Feed("aws", raw, fmt="parquet")
    lake.ingest(feed)
    base.withColumn("novo", F.lit(7)).withColumn("id_transacao", F.lit("t2")).write.mode("append").parquet(raw)
    lake.ingest(feed)
    assert rows(lake.bronze("aws"), "id_transacao", "novo") == [("t1", None), ("t2", 7)]


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master, applicationId = "yarn", "app"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_root(Cluster)


def test_nested_columns_have_no_measured_size(spark):
    with pytest.raises(ValueError, match="plain"):
        sizes.measured_bytes(spark.createDataFrame([([1],)], "a array<int>"))
