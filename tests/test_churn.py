import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tidemark.functions import values as V
from tidemark.operators import attribution as A
from tidemark.operators import churn as K
from tidemark.operators import metrics as M
from tidemark.session import run_dir


def brute(data):
    pos = [s for y, s in data if y == 1]
    neg = [s for y, s in data if y != 1]
    auc = None
    if pos and neg:
        auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ap = None
    if pos:
        ap = 0.0
        for level in sorted({s for _, s in data}, reverse=True):
            tp, seen = sum(s >= level for s in pos), sum(s >= level for _, s in data)
            ap += sum(s == level for s in pos) / len(pos) * tp / seen
    tp = sum(s >= 0.5 for s in pos)
    fp = sum(s >= 0.5 for s in neg)
    fn = len(pos) - tp
    pr = tp / (tp + fp) if tp + fp else 0.0
    rc = tp / (tp + fn) if tp + fn else 0.0
    f1 = 2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0.0
    return {"auc": auc, "average_precision": ap, "precision": pr, "recall": rc, "f1": f1}


def models():
    rng = random.Random(5)
    return {
        "ties": [(rng.randrange(2), rng.randrange(4) / 4) for _ in range(80)],
        "fine": [(int(rng.random() < 0.3), rng.random()) for _ in range(120)],
        "only_neg": [(0, rng.random()) for _ in range(10)],
        "only_pos": [(1, 0.2)] * 5,
        "one_level": [(1, 0.7), (0, 0.7), (0, 0.7)],
    }


def test_metrics_against_brute_force(spark):
    data = models()
    df = spark.createDataFrame([(m, y, s) for m, rs in data.items() for y, s in rs], "m string, label int, score double")
    got = {r.m: r.asDict() for r in M.all_metrics(df.repartition(4), by=["m"]).collect()}
    for name, rs in data.items():
        for metric, want in brute(rs).items():
            have = got[name][metric]
            assert have is None if want is None else have == pytest.approx(want, abs=1e-12), (name, metric)
    single = M.all_metrics(df.filter("m = 'fine'")).first()
    assert single.auc == pytest.approx(got["fine"]["auc"])
    spark_auc = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(
        df.filter("m = 'ties'").withColumn("label", F.col("label").cast("double"))
    )
    assert spark_auc == pytest.approx(got["ties"]["auc"])


def test_split_is_exact_and_repeatable(spark):
    df = spark.range(1000).select(
        F.col("id").cast("string").alias("id_cliente"), (F.col("id") % 10 == 0).cast("int").alias("churn")
    )
    parts = {"train": 0.68, "val": 0.12, "test": 0.2}
    one = K.stratified_split(df, parts)
    two = K.stratified_split(df.repartition(7), parts)
    assert rows(one) == rows(two)
    assert rows(one.groupBy("part", "churn").count()) == [
        ("test", 0, 180), ("test", 1, 20), ("train", 0, 612), ("train", 1, 68), ("val", 0, 108), ("val", 1, 12),
    ]
    other = K.stratified_split(df, parts, seed=1)
    assert rows(one) != rows(other)


def customers(spark, n=400):
    """Churn follows recency with a little noise."""
    rng = random.Random(9)
    recs = []
    for i in range(n):
        r, f = rng.randrange(1, 120), rng.randrange(1, 20)
        recs.append((f"c{i:04d}", r, f, f * 10.0, 3, 3, 3, 333, rng.choice(["Leal", "Regular"]), int(r + rng.randrange(-15, 15) > 60)))
    return spark.createDataFrame(
        recs, "id_cliente string, recency_dias int, frequency long, monetary double, r_score int, f_score int, "
        "m_score int, rfm_score int, segmento string, churn int",
    )


def test_training_end_to_end(spark):
    df = K.stratified_split(customers(spark), {"train": 0.68, "val": 0.12, "test": 0.2}).cache()
    train, val, test = (df.filter(F.col("part") == p).drop("part") for p in ("train", "val", "test"))
    best, log = K.random_search(train, val, K.SMALL_SPACE, trials=3)
    again, _ = K.random_search(train, val, K.SMALL_SPACE, trials=3)
    assert best == again and log.count() == 3
    assert log.agg(F.max("auc")).first()[0] == log.filter(F.col("maxIter") == best["maxIter"]).agg(F.max("auc")).first()[0]
    model, measured = K.fit_final(train, val, test, best)
    assert measured.first().auc > 0.85
    importance = K.permutation_importance(model, test, ["recency_dias", "frequency", "segmento"])
    assert importance.first().feature == "recency_dias"
    path = run_dir(spark, "model")
    row = K.register(spark, model, path, "churn_predictor", 1, measured.first().auc, dt.datetime(2024, 1, 1), test).first()
    loaded = K.PipelineModel.load(row.path)
    assert rows(K.score(loaded, test), "id_cliente", "score") == rows(K.score(model, test), "id_cliente", "score")
    assert row.input_example.count("id_cliente") == 5
    assert '"score"' in row.output_schema and '"score"' not in row.input_schema


def test_promotion(spark):
    ddl = "name string, version int, auc double, stage string"
    reg = [
        ("new", 1, 0.8, "None"), ("new", 2, 0.8, "None"), ("weak", 1, 0.74, "None"),
        ("same", 1, 0.9, "Production"), ("same", 2, 0.85, "None"),
        ("better", 1, 0.8, "Production"), ("better", 2, 0.81, "None"),
    ]
    assert rows(K.promote(spark.createDataFrame(reg, ddl)), "name", "version") == [("better", 2), ("new", 1)]


def test_search_that_learns(spark):
    df = K.stratified_split(customers(spark), {"train": 0.68, "val": 0.12, "test": 0.2}).cache()
    train, val = (df.filter(F.col("part") == p).drop("part") for p in ("train", "val"))
    best, log = K.parzen_search(train, val, K.SMALL_SPACE, trials=10, parallel=2)
    found = log.orderBy("trial").collect()
    assert [r["trial"] for r in found] == list(range(10)) and len({r["stepSize"] for r in found}) == 10
    top = max(found, key=lambda r: (r["auc"], -r["trial"]))
    assert all(best[k] == top[k] for k in best)
    low, high, step = K.SMALL_SPACE.trees
    assert all(low <= r["maxIter"] <= high and (r["maxIter"] - low) % step == 0 for r in found)
    assert K.parzen_search(train, val, K.SMALL_SPACE, trials=3, parallel=2)[0] == K.parzen_search(train, val, K.SMALL_SPACE, trials=3, parallel=2)[0]


def test_attribution_of_scored_rows(spark):
    df = customers(spark)
    model = K.train_gbt(df, {"maxDepth": 3, "maxIter": 4})
    found = K.attributed(model, df)
    total = sum((F.col("attribution")[c] for c in V.FEATURES), F.col("base"))
    assert found.filter(F.abs(total - F.col("margin")) > 1e-9).isEmpty() and found.count() == 400
    order = [r["feature"] for r in A.mean_attribution(found, V.FEATURES).collect()]
    assert order[0] == "recency_dias"


def test_stages_after_promotion(spark):
    ddl = "name string, version int, auc double, stage string"
    reg = [
        ("new", 1, 0.8, "None"), ("new", 2, 0.7, "None"), ("weak", 1, 0.74, "None"),
        ("better", 1, 0.8, "Production"), ("better", 2, 0.81, "None"), ("same", 1, 0.9, "Production"), ("same", 2, None, "None"),
    ]
    got = K.with_stages(spark.createDataFrame(reg, ddl))
    assert rows(got, "name", "version", "stage") == [
        ("better", 1, "Archived"), ("better", 2, "Production"), ("new", 1, "Production"), ("new", 2, "None"),
        ("same", 1, "Production"), ("same", 2, "None"), ("weak", 1, "None"),
    ]
    entries = got.withColumn("entry", F.lit(1)).unionByName(
        spark.createDataFrame([("weak", 1, 0.74, "Archived", 2)], ddl + ", entry int"))
    assert rows(K.latest_stages(entries).filter("name = 'weak'"), "stage") == [("Archived",)]


def test_category_index_is_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",)], "segmento string")
    assert rows(K.index_col(df).distinct()) == [("a", 0.0), ("b", 1.0), ("c", 2.0)]
