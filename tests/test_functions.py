import itertools

from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.functions import values as V


def one(spark, ddl, values, expression):
    df = spark.createDataFrame([(v,) for v in values], ddl)
    return [r[0] for r in df.select(expression).collect()]


def test_band_edges_belong_to_the_upper_band(spark):
    values = [99.99, 100.0, 999.99, 1000.0, 9999.99, 10000.0, None, float("nan")]
    got = one(spark, "v double", values, C.band("v", V.BAND_EDGES, V.BAND_LABELS))
    assert got == ["baixo", "medio", "medio", "alto", "alto", "premium", None, None]


def test_texts(spark):
    assert one(spark, "v string", ["  app ", None, "\tx"], C.normalised("v")) == ["APP", None, "\tX"]
    assert one(spark, "v string", ["C-00 1/é", None], C.clean_id("v")) == ["C001", None]


def test_money_is_rounded_half_up(spark):
    assert one(spark, "v double", [1.005, 0.285, -1.005, None], C.money_round("v")) == [1.01, 0.29, -1.01, None]


def test_mean_from_cents(spark):
    df = spark.createDataFrame([(5, 2), (-5, 2), (0, 0), (100, 3)], "t long, n long")
    assert [r[0] for r in df.select(C.mean_from_cents("t", "n")).collect()] == [0.03, -0.03, None, 0.33]


def test_growth_without_base_is_null(spark):
    df = spark.createDataFrame([(110.0, 100.0), (1.0, 0.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(C.pct_change("a", "b")).collect()] == [10.0, None, None]


def test_segments_of_all_scores(spark):
    combos = list(itertools.product(range(1, 6), repeat=3))
    df = spark.createDataFrame(combos, "r int, f int, m int").withColumn("t", C.rfm_total("r", "f", "m"))
    got = df.select("r", "f", "m", C.segment("r", "f", "t").alias("a"), C.segment("r", "f", "t", True).alias("b")).collect()
    for row in got:
        total = row.r * 100 + row.f * 10 + row.m
        rest = "Inativo" if row.r <= 2 else "Regular"
        novo, risco = row.r >= 4 and row.f <= 2, row.r <= 2 and row.f >= 4
        score = "Campeao" if total >= 444 else "Leal" if total >= 333 else None
        profile = "Novo" if novo else "Em_Risco" if risco else None
        assert row.a == (score or profile or rest)
        assert row.b == (profile or score or rest)
    assert "Novo" not in {r.a for r in got} and "Novo" in {r.b for r in got}


def test_churn_label_of_null_is_zero(spark):
    assert one(spark, "v int", [30, 31, None], C.churn_label("v")) == [0, 1, 0]


def test_digital_flag_keeps_null(spark):
    assert one(spark, "v string", ["APP", "LOJA", None], F.col("v").isin(*V.DIGITAL_CHANNELS)) == [True, False, None]
