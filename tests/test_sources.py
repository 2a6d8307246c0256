import datetime as dt
import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import layout, rules
from tidemark.session import run_dir
from tidemark.sources import files, sinks
from tidemark.sources.snapshots import SnapshotTable
from tidemark.streaming.ingest import run_ingest, write_batch

SCHEMA = "id_transacao string, valor double"


def local(path):
    os.makedirs(path, exist_ok=True)
    return path


def drop_file(folder, name, records):
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n")


def test_only_new_files_are_read(spark):
    root = run_dir(spark, "stream")
    source = local(root + "/in")
    run = lambda: run_ingest(
        files.with_lineage(files.stream_files(spark, source, "json", SCHEMA), "azure"),
        rules.ingest_rules(), root + "/ok", root + "/bad", root + "/check",
    )
    drop_file(source, "a.json", [{"id_transacao": "1", "valor": 1.0}, {"valor": 2.0}, {"id_transacao": "3", "valor": -1}])
    assert run() == [{"batch_id": 0, "validos": 1, "quarentena": 2}]
    assert run() == []
    drop_file(source, "b.json", [{"id_transacao": "4", "valor": 0.0}])
    assert run() == [{"batch_id": 1, "validos": 1, "quarentena": 0}]
    ok = sinks.read_merged(spark, root + "/ok")
    assert rows(ok, "id_transacao", "_cloud_origem") == [("1", "azure"), ("4", "azure")]
    assert {os.path.basename(r._source_file) for r in ok.collect()} == {"a.json", "b.json"}
    assert ok.select("_ingestion_time").distinct().count() == 2


def test_replayed_batch_changes_nothing(spark):
    root = run_dir(spark, "replay")
    batch = spark.createDataFrame([("1", 1.0), (None, 2.0)], SCHEMA)
    for _ in range(2):
        counts = write_batch(batch, 0, rules.ingest_rules(), root + "/ok", root + "/bad")
        assert counts == {"validos": 1, "quarentena": 1}
    write_batch(batch.withColumn("novo", F.lit(7)), 1, rules.ingest_rules(), root + "/ok", root + "/bad")
    ok = sinks.read_merged(spark, root + "/ok")
    assert rows(ok, "batch_id", "novo") == [(0, None), (1, 7)]
    assert spark.read.parquet(root + "/bad").count() == 2


def test_schema_grows_and_base_types_win(spark):
    root = run_dir(spark, "schema")
    store = files.SchemaStore(spark, root)
    assert store.get(SCHEMA).names == ["id_transacao", "valor"]
    grown = store.evolve(SCHEMA, "valor string, novo struct<a: int>")
    assert grown.simpleString() == "struct<id_transacao:string,valor:double,novo:struct<a:int>>"
    assert store.evolve(SCHEMA, "valor string") == grown and store._stored() == 1
    assert store.evolve(SCHEMA, "outro int").names == ["id_transacao", "valor", "novo", "outro"]


def test_rescue(spark):
    lines = [
        '{"id_transacao":"1","valor":1.5,"extra":"e"}', '{"id_transacao":"2","valor":"abc"}',
        '{"id_transacao":"3","valor":1,"no":{"a":[1]}}', "not json", '{"id_transacao":"4","valor":null}',
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "n int, value string")
    got = {r.n: r for r in files.with_rescue(df, SCHEMA).collect()}
    assert (got[0].valor, got[0]._rescue, got[0]._corrupt) == (1.5, '{"extra":"e"}', None)
    assert (got[1].id_transacao, got[1].valor, got[1]._rescue) == ("2", None, '{"valor":"abc"}')
    assert json.loads(json.loads(got[2]._rescue)["no"]) == {"a": [1]}
    assert got[3]._corrupt == "not json" and got[3].id_transacao is None
    assert got[4]._rescue is None and got[4]._corrupt is None


def test_high_water(spark):
    marks = files.HighWater(spark, run_dir(spark, "marks"))
    assert marks.get("a") is None
    marks.advance("a", dt.datetime(2024, 1, 2))
    marks.advance("a", dt.datetime(2024, 1, 1))
    marks.advance("b", dt.datetime(2023, 1, 1))
    assert marks.get("a") == dt.datetime(2024, 1, 2)


def test_slice_overwrite_leaves_the_rest(spark):
    path = run_dir(spark, "slices")
    day = lambda d, v: spark.createDataFrame([(dt.date(2024, 1, d), v)], "dia date, v int")
    sinks.overwrite(day(1, 1).unionByName(day(2, 2)), path, ["dia"])
    sinks.replace_slice(day(2, 20).unionByName(day(1, 99)), path, "dia", "2024-01-02")
    assert rows(spark.read.parquet(path), "v") == [(1,), (20,)]
    sinks.overwrite(day(3, 3), path, ["dia"])
    assert rows(spark.read.parquet(path), "v") == [(3,)]


def test_result_log_appends(spark):
    path = run_dir(spark, "log")
    for _ in range(2):
        sinks.append_results(spark.range(2), path)
    assert spark.read.parquet(path).count() == 4


T = lambda d: dt.datetime(2024, 1, d)


def test_snapshots(spark):
    table = SnapshotTable(spark, run_dir(spark, "snap"))
    assert table.history().isEmpty()
    for d in (1, 2, 3):
        table.write(spark.range(d), T(d))
    assert [table.read(v).count() for v in (0, 1, 2)] == [1, 2, 3]
    assert table.read(timestamp=T(2) + dt.timedelta(hours=3)).count() == 2
    assert [(r.version, r.rows) for r in table.history(2).collect()] == [(2, 3), (1, 2)]
    with pytest.raises(LookupError):
        table.read(timestamp=dt.datetime(2023, 1, 1))
    with pytest.raises(ValueError):
        table.restore(T(4))
    assert table.restore(T(4), version=0) == 3 and table.read().count() == 1
    copy = table.clone(run_dir(spark, "copy"), T(5), version=2)
    copy.restore(T(6), version=0)
    assert copy.read().count() == 3
    assert rows(table.expired(T(4), hours=24), "version") == [(0,), (1,)]
    assert table.expire(T(4), hours=24).count() == 2 and table.read(0).count() == 1
    table.expire(T(4), hours=24, dry_run=False)
    assert rows(table.commits(), "version") == [(2,), (3,)]
    with pytest.raises(LookupError):
        table.read(0)
    assert table.expired(dt.datetime(2030, 1, 1)).count() == 1  # the newest stays
    assert table.write(spark.range(9), T(9)) == 4


def test_unfinished_version_is_invisible(spark):
    table = SnapshotTable(spark, run_dir(spark, "half"))
    table.write(spark.range(1), T(1))
    spark.range(50).write.parquet(table._folder(1))
    assert table.read().count() == 1
    assert table.write(spark.range(2), T(2)) == 1 and table.read().count() == 2


def test_compaction_keeps_the_rows(spark):
    path = run_dir(spark, "compact")
    df = spark.range(2000).select(F.col("id"), (F.col("id") % 3).cast("string").alias("p"), F.rand(1).alias("x"))
    df.repartition(8).write.partitionBy("p").parquet(path)
    one = layout.compact(spark, path, {"p": "1"})
    assert one["files_before"] == 8 and one["files_after"] == 1
    every = layout.compact(spark, path, cluster_by=["id", "x"])
    assert every["files_before"] == 17 and every["files_after"] < 17
    assert rows(spark.read.parquet(path), "id") == rows(df, "id")
    with pytest.raises(ValueError):
        layout.compact(spark, path, {"id": 1})


def test_clustering_narrows_the_files(spark):
    df = spark.range(4000).select(
        F.concat(F.lit("Customer#"), F.lpad(F.pmod(F.xxhash64("id"), F.lit(500)).cast("string"), 6, "0")).alias("c"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(300)).cast("int")).alias("d"),
        "id",
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = layout.clustered(df, ["c", "d"]).withColumn("f", F.spark_partition_id()).cache()
        placed.count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert rows(placed, "id") == rows(df, "id")
    spans = placed.groupBy("f").agg(F.min("c"), F.max("c"), F.min("d").cast("string"), F.max("d").cast("string")).collect()
    assert len(spans) >= 6
    touched = lambda low, high, v: sum(s[low] <= v <= s[high] for s in spans)
    # Range edges are sampled, so values beside a cell's edge may touch files on both sides: take the mean of several.
    ids = [f"Customer#{k:06d}" for k in range(30, 500, 60)]
    days = [str(dt.date(2024, 1, 1) + dt.timedelta(days=k)) for k in range(20, 300, 40)]
    assert sum(touched(1, 2, v) for v in ids) / len(ids) <= len(spans) * 0.75
    assert sum(touched(3, 4, v) for v in days) / len(days) <= len(spans) * 0.75


def test_clustering_splits_a_hot_value(spark):
    df = spark.range(3000).select(F.lit("x").alias("s"), F.lit(1).alias("n"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = layout.clustered(df, ["s", "n"]).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(r["count"] for r in sizes) < 1000


def test_only_new_files_are_looked_at_for_their_schema(spark):
    source = local(run_dir(spark, "infer"))
    drop_file(source, "a.json", [{"a": 1}])
    os.utime(source + "/a.json", (1_700_000_000, 1_700_000_000))
    first = files.newest_file(spark, source)
    assert first.timestamp() == 1_700_000_000
    drop_file(source, "b.json", [{"b": 1}])
    assert files.infer_json(spark, source).names == ["a", "b"]
    assert files.infer_json(spark, source, first).names == ["b"]


def test_time_bounds_reach_the_scan(spark, small):
    from conftest import plan_of

    from tidemark.operators.relational import read_since
    from tidemark.sources import views as W

    plan = plan_of(read_since(W.table(spark, small, "events"), "ts", T(10), T(15)))
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_fields_are_looked_through_only_where_something_does_not_fit(spark):
    lines = spark.createDataFrame(
        [(0, '{"k": 1, "s": "a"}'), (1, '{"k": "x", "s": "a"}'), (2, '{"k": 1, "n": 2}'), (3, '{"k": null}'), (4, "{}"), (5, "[1]")],
        "i int, value string",
    )
    out = files.with_rescue(lines, "k bigint, s string")
    got = [(r.k, r.s, r._rescue, r._corrupt) for r in out.orderBy("i").collect()]
    assert got == [
        (1, "a", None, None), (None, "a", '{"k":"x"}', None), (1, None, '{"n":"2"}', None),
        (None, None, None, None), (None, None, None, None), (None, None, None, "[1]"),
    ]
    # The fields of a line are filtered in one place, under the condition, and by names made before.
    assert out._jdf.queryExecution().optimizedPlan().toString().count("map_filter(") == 1
