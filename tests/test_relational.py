import datetime as dt

from conftest import plan_of, rows
from pyspark.sql import functions as F

from tidemark.functions import values as V
from tidemark.operators import relational as R
from tidemark.sources import views as W


def test_dedup_prefers_ingestion_then_event_time(spark):
    t = dt.datetime
    data = [
        ("a", t(2024, 1, 1), t(2024, 2, 1), "old event"),
        ("a", t(2024, 1, 2), t(2024, 2, 1), "new event"),
        ("b", t(2024, 1, 9), t(2024, 2, 1), "old load"),
        ("b", t(2024, 1, 1), t(2024, 2, 2), "new load"),
    ]
    df = spark.createDataFrame(data, "id_transacao string, dt_transacao timestamp, _ingestion_time timestamp, x string")
    got = R.dedup_by_ingestion(df)
    assert rows(got, "id_transacao", "x") == [("a", "new event"), ("b", "new load")]
    # Full ties are settled by content, the same way in any order of the input.
    same = spark.createDataFrame(
        [("k", t(2024, 1, 1), t(2024, 1, 1), str(i)) for i in range(20)], df.schema
    )
    kept = {R.dedup_by_ingestion(same.repartition(n)).first().x for n in (1, 3, 5)}
    assert len(kept) == 1


def test_dedup_limits_groups_before_the_shuffle(spark, small):
    plan = plan_of(W.latest_lines(spark, small))
    assert plan.count("WindowGroupLimit") == 2


def test_date_filters_reach_the_scan(spark, small):
    orders = W.table(spark, small, "orders")
    plan = plan_of(R.last_days(orders, "o_orderdate", "2001-08-01", 365).select("o_orderkey"))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_last_days_bounds(spark):
    days = ["2000-08-01", "2000-08-02", "2001-08-01", "2001-08-02"]
    df = spark.createDataFrame([(dt.datetime.fromisoformat(d),) for d in days], "ts timestamp_ntz")
    kept = [r.ts.date().isoformat() for r in R.last_days(df, "ts", "2001-08-01", 365).orderBy("ts").collect()]
    assert kept == ["2000-08-01", "2000-08-02", "2001-08-01"]


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, tag string")
    b = spark.createDataFrame([(2,)], "id int")
    assert rows(R.union_sources(a, b)) == [(1, "x"), (2, None)]


def test_diff_sees_nulls(spark):
    a = spark.createDataFrame([(1, None), (2, 5), (3, 7), (4, 1)], "id int, v int")
    b = spark.createDataFrame([(1, 5), (2, None), (3, 7), (5, 1)], "id int, v int")
    assert rows(R.diff_versions(a, b, ["id"])) == [(1, "changed"), (2, "changed"), (4, "removed"), (5, "added")]


def test_contract(spark):
    df = spark.createDataFrame([("1", "c", 3)], "id_transacao string, extra string, valor int")
    got = R.conform(df, V.SILVER_SCHEMA)
    assert len(got.columns) == 19 and got.schema["valor"].dataType.simpleString() == "double"
    gaps = R.contract_gaps(df, V.SILVER_SCHEMA)
    assert gaps["extra"] == ["extra"] and gaps["retyped"] == ["valor"] and "canal" in gaps["missing"]


def test_top_n(spark):
    assert [r.id for r in R.top_n(spark.range(50), [F.desc("id")], 3).collect()] == [49, 48, 47]
    assert "TakeOrderedAndProject" in plan_of(R.top_n(spark.range(50), [F.desc("id")], 3))


def brute_diff(a, b):
    """Keys (first column) whose rows are not the same as often."""
    from collections import Counter

    out = []
    for k in {r[0] for r in a} | {r[0] for r in b}:
        x, y = (Counter(r for r in side if r[0] == k) for side in (a, b))
        if x != y:
            out.append((k, "added" if not x else "removed" if not y else "changed", sum(x.values()), sum(y.values())))
    return sorted(out, key=lambda r: (r[0] is not None, str(r[0])))


def test_diff_counts_copies_and_null_keys(spark):
    import random

    rng = random.Random(4)
    a = [(rng.choice([None, *range(40)]), rng.choice([None, 1, 2]), rng.choice("xy")) for _ in range(300)]
    b = [r for r in a if rng.random() < 0.98] + [(rng.randrange(60), 1, "z") for _ in range(3)] + a[:2]
    frames = [spark.createDataFrame(x, "id int, v int, w string").repartition(3) for x in (a, b)]
    for buckets in (1, 7, R.DIFF_BUCKETS):
        assert rows(R.diff_versions(*frames, ["id"], buckets, copies=True)) == brute_diff(a, b)
    assert R.diff_versions(frames[0], frames[0].repartition(5), ["id"]).count() == 0
    assert rows(R.diff_versions(frames[0], frames[0].limit(0), ["id"], copies=True)) == brute_diff(a, [])


def test_diff_moves_rows_of_differing_buckets_only(spark):
    old = spark.range(20_000).select("id", (F.col("id") * 3).alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    new = old.withColumn("v", F.when(F.col("id") == 77, 0).otherwise(F.col("v")))
    sides = [R._digests(df, ["id"], ["v", "text"], R.DIFF_BUCKETS) for df in (old, new)]
    (bucket,) = R.differing_buckets(*sides).collect()
    got = R.diff_versions(old, new, ["id"])
    assert rows(got) == [(77, "changed")]
    # One grouping of keys and digests behind the buckets that differ, which are broadcast.
    plan = plan_of(R.diff_versions(old, new, ["id"]))
    assert plan.count("Exchange hashpartitioning(id") == 1 and "SortMergeJoin" not in plan and "LeftSemi" in plan
    assert sides[0].filter(F.col("__bucket") == bucket["__bucket"]).count() < 30


def test_contract_is_enforced_on_write(spark, tmp_path):
    import pytest

    ddl = "id string NOT NULL, n int, day date NOT NULL"
    good = spark.createDataFrame([("a", 1, dt.date(2024, 1, 1)), ("b", None, dt.date(2024, 1, 2))], "id string, n int, day date")
    R.enforced(good.withColumn("extra", F.lit(1)), ddl).write.parquet(str(tmp_path / "good"))
    assert rows(spark.read.parquet(str(tmp_path / "good"))) == rows(good)
    bad = good.withColumn("day", F.when(F.col("id") == "a", F.col("day")))
    assert rows(R.contract_breaks(bad, ddl), "id", "problem") == [("a", None), ("b", "day nulo")]
    with pytest.raises(Exception, match="day: null where the contract"):
        R.enforced(bad, ddl).write.parquet(str(tmp_path / "bad"))
    assert not (tmp_path / "bad" / "_SUCCESS").exists()
    for broken in (good.drop("n"), good.withColumn("n", F.col("n").cast("long"))):
        with pytest.raises(R.ContractError):
            R.enforced(broken, ddl)


def test_rfm_is_written_under_its_contract(spark, small):
    from tidemark.operators.gold import rfm

    orders = W.orders_tx(spark, small)
    from tidemark.operators.silver import cleanse

    assert R.contract_gaps(rfm(cleanse(orders), "2001-08-01"), V.RFM_SCHEMA) == {"missing": [], "extra": [], "retyped": []}
