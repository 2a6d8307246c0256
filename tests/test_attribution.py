from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.operators import attribution as A

NAMES = ["a", "b", "c", "kind"]


@pytest.fixture(scope="module")
def fitted(spark):
    rows = spark.range(600).select(
        (F.pmod(F.xxhash64("id"), F.lit(40)) / 4).alias("a"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(9))).cast("double").alias("b"),
        F.pmod(F.col("id"), F.lit(7)).cast("double").alias("c"),
        F.element_at(F.array(*[F.lit(k) for k in "uvwxy"]), (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(5)) + 1).cast("int")).alias("k"),
    ).withColumn("label", ((F.col("a") + F.when(F.col("k").isin("u", "x"), 4).otherwise(0) - F.col("b") / 2 > 5)).cast("int"))
    prepared = Pipeline(stages=[
        StringIndexer(inputCol="k", outputCol="kind"), VectorAssembler(inputCols=NAMES, outputCol="features"),
    ]).fit(rows).transform(rows).cache()
    model = GBTClassifier(labelCol="label", maxDepth=4, maxIter=6, seed=3).fit(prepared)
    return model, prepared


def expectation(tree, at, row, known):
    """The mean of a tree when a split on an unknown feature is taken both ways."""
    node = tree[at]
    if node.split is None:
        return node.value
    left, right = node.children
    if node.split.feature in known:
        v = row[node.split.feature]
        goes = v <= node.split.threshold if node.split.threshold is not None else v in node.split.left
        return expectation(tree, left if goes else right, row, known)
    shares = [tree[c].rows / node.rows for c in (left, right)]
    return sum(s * expectation(tree, c, row, known) for s, c in zip(shares, (left, right), strict=True))


def brute(trees, row):
    """Over all sets of features."""
    n = len(row)
    value = {s: sum(expectation(t, 0, row, s) for t in trees) for k in range(n + 1) for s in map(frozenset, combinations(range(n), k))}
    out = []
    for i in range(n):
        total = 0.0
        for s in value:
            if i not in s:
                total += factorial(len(s)) * factorial(n - len(s) - 1) / factorial(n) * (value[s | {i}] - value[s])
        out.append(total)
    return out, value[frozenset()]


def test_values_equal_brute_force_over_all_sets(spark, fitted):
    model, prepared = fitted
    trees = A.read_trees(spark, model)
    assert any(n.split and n.split.threshold is None for t in trees for n in t.values())  # a categorical split
    rows = A.shapley(model, prepared.limit(25), NAMES).collect()
    for r in rows:
        want, base = brute(trees, r["features"].toArray().tolist())
        assert np.allclose([r["attribution"][n] for n in NAMES], want, atol=1e-9)
        assert r["base"] == pytest.approx(base)


def test_values_sum_to_the_margin(spark, fitted):
    model, prepared = fitted
    found = A.shapley(model, prepared, NAMES)
    total = sum((F.col("attribution")[n] for n in NAMES), F.col("base"))
    worst = found.agg(F.max(F.abs(total - F.col("margin"))).alias("w"), F.count(F.lit(1)).alias("n")).first()
    assert worst["n"] == 600 and worst["w"] < 1e-9
    # The margin is the model's own.
    apart = F.abs(F.lit(1) / (1 + F.exp(-2 * F.col("margin"))) - vector_to_array("probability")[1])
    assert found.where(apart > 1e-9).count() == 0


def test_a_feature_without_effect_gets_nothing(spark, fitted):
    model, prepared = fitted
    order = [r["feature"] for r in A.mean_attribution(A.shapley(model, prepared, NAMES), NAMES).collect()]
    assert order[-1] == "c" and set(order) == set(NAMES)


def test_one_leaf_and_repeated_features():
    split = A.Split(0, 2.0, frozenset())
    deep = A.Split(0, 1.0, frozenset())
    tree = {
        0: A.Node(0, 10, split, (1, 4)), 1: A.Node(0, 6, deep, (2, 3)), 2: A.Node(5.0, 2, None, (-1, -1)),
        3: A.Node(1.0, 4, None, (-1, -1)), 4: A.Node(-3.0, 4, None, (-1, -1)),
    }
    x = np.array([[0.5, 9], [1.5, 9], [7.0, 9]])
    got = A.shapley_rows(x, A.leaf_paths(tree))
    for row, values in zip(x, got, strict=True):
        assert np.allclose(values, brute([tree], row.tolist())[0])
    lone = {0: A.Node(2.5, 3, None, (-1, -1))}
    assert A.expected(A.leaf_paths(lone)) == 2.5 and not A.shapley_rows(x, A.leaf_paths(lone)).any()
