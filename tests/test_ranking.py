import random

import pytest
from conftest import plan_of, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import ranking
from tidemark.operators.ranking import Key, ntile_global, number_rows, running_sums


@pytest.mark.parametrize("n", [0, 1, 3, 5, 7, 11, 200])
def test_ntile_equals_the_window_function(spark, n):
    rng = random.Random(n)
    data = [(i, rng.choice([None, 1.0, 2.0, 3.0])) for i in range(n)]
    df = spark.createDataFrame(data, "id long, v double").repartition(4)
    for desc in (False, True):
        got = ntile_global(df, 5, [Key("v", desc), "id"], "t")
        order = [F.desc("v") if desc else F.asc("v"), "id"]
        want = df.withColumn("t", F.ntile(5).over(Window.orderBy(*order)))
        assert rows(got) == rows(want)
        assert "SinglePartition" not in plan_of(got)


def test_ntile_splits_one_value(spark):
    df = spark.range(1000).withColumn("v", F.lit(7))
    got = ntile_global(df, 5, ["v", "id"], "t").groupBy("t").count()
    assert rows(got) == [(t, 200) for t in range(1, 6)]


def test_ntile_with_nan_and_texts(spark):
    df = spark.createDataFrame([("b", float("nan")), ("a", float("nan")), ("c", 1.0), ("d", -1.0), ("e", 2.0)], "k string, v double")
    got = ntile_global(df, 5, ["v", "k"], "t")
    assert {r.k: r.t for r in got.collect()} == {"d": 1, "c": 2, "e": 3, "a": 4, "b": 5}


def test_row_numbers(spark):
    df = spark.range(500).withColumn("v", F.col("id") % 7).repartition(6)
    got = number_rows(df, [Key("v", True), "id"], "rn")
    want = df.withColumn("rn", F.row_number().over(Window.orderBy(F.desc("v"), "id")).cast("long"))
    assert rows(got, "id", "rn") == rows(want, "id", "rn")
    assert "SinglePartition" not in plan_of(got)


def test_running_sums(spark):
    df = spark.range(300).withColumn("x", (F.col("id") * 13) % 11).repartition(5)
    got = running_sums(df, ["id"], {"total": "x"})
    want = df.withColumn("total", F.sum("x").over(Window.orderBy("id")))
    assert rows(got, "id", "total") == rows(want, "id", "total")


@pytest.mark.parametrize("bracket", [200_000, 5])
def test_ends_are_selected_or_sorted(spark, monkeypatch, bracket):
    """Skewed, tied, negative and descending values; with a small bracket the sort takes over."""
    monkeypatch.setattr(ranking, "BRACKET_ROWS", bracket)
    rng = random.Random(6)
    data = [(f"k{i:05d}", rng.choice([1, 1, 1, 2, 3, 50]), rng.gauss(0, 1) ** 3, i % 365) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, f long, m double, r int").repartition(5).cache()
    orders = [[Key("f"), "k"], [Key("m"), Key("k")], [Key("r", descending=True), "k"], [Key("m", True), "k"]]
    got = ranking.tile_ends_many(df, 5, orders)
    for ends, order in zip(got, orders, strict=True):
        by = [F.desc(o.name) if isinstance(o, Key) and o.descending else F.asc(o.name if isinstance(o, Key) else o) for o in order]
        want = df.withColumn("t", F.ntile(5).over(Window.orderBy(*by)))
        assert rows(df.withColumn("t", ranking.tile_of(ends, order))) == rows(want)
    selected = ranking._bracketed(df, 5, [ranking._keys(o) for o in orders])
    # Hardly any rows share an interval of ``m``, so five are enough there.
    assert set(selected) == ({0, 1, 2, 3} if bracket > 5 else {1, 3})
    nulls = df.withColumn("f", F.when(F.col("r") > 9, F.col("f")))
    assert ranking._bracketed(nulls, 5, [ranking._keys(orders[0])]) == {}
