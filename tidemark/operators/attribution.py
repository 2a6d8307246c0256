"""Exact Shapley values of boosted trees, along the paths from their roots to their leaves.

The value of a set of known features is the expectation of the trees when a split on an unknown feature sends a row
both ways, in the shares of the training rows that went there. A leaf then counts with a product over the features
on its path: whether the row satisfies their splits (known), or the share that went along (unknown). The Shapley
value is a weighted sum of such products over all sets, and the products by set size are the coefficients of a
polynomial, so a path of d features takes about d^3 steps in place of 2^d sets.

Rows are worked on in Arrow batches on the executors; a leaf is evaluated once per pattern of satisfied features that
occurs in a batch. Only the trees themselves travel.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from math import factorial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import remove_folder, run_dir

# The arithmetic travels with its functions: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Split(NamedTuple):
    """Left are values up to the threshold, or the listed categories."""

    feature: int
    threshold: float | None
    left: frozenset[float]


class Node(NamedTuple):
    value: float
    rows: float
    split: Split | None
    children: tuple[int, int]


class Path(NamedTuple):
    """A leaf: its weighted value and, per feature on its path, the splits with the side taken and the share that went along."""

    value: float
    features: list[int]
    taken: list[list[tuple[Split, bool]]]
    shares: np.ndarray


def read_trees(spark: SparkSession, model: GBTClassificationModel) -> list[dict[int, Node]]:
    """The nodes of every tree, from the model's own stored form; leaf values carry the tree's weight."""
    folder = run_dir(spark, "trees")
    model.write().overwrite().save(folder)
    rows = spark.read.parquet(f"{folder}/data").select("treeID", "nodeData.*").collect()  # as large as the model
    remove_folder(spark, folder)
    trees: list[dict[int, Node]] = [{} for _ in model.treeWeights]
    for r in rows:
        split = None
        if r["leftChild"] >= 0:
            s = r["split"]
            number = s["numCategories"]
            values = s["leftCategoriesOrThreshold"]
            split = Split(s["featureIndex"], values[0] if number < 0 else None, frozenset() if number < 0 else frozenset(values))
        weight = model.treeWeights[r["treeID"]]
        trees[r["treeID"]][r["id"]] = Node(weight * r["prediction"], float(r["rawCount"]), split, (r["leftChild"], r["rightChild"]))
    return trees


def leaf_paths(tree: dict[int, Node]) -> list[Path]:
    """Every leaf of a tree; splits on one feature are one entry."""
    out, open_ = [], [(0, [])]
    while open_:
        at, steps = open_.pop()
        node = tree[at]
        if node.split is None:
            features = sorted({s.feature for s, _, _ in steps})
            of = lambda f: [(s, left) for s, left, _ in steps if s.feature == f]
            shares = np.array([np.prod([share for s, _, share in steps if s.feature == f]) for f in features])
            out.append(Path(node.value, features, [of(f) for f in features], shares))
            continue
        for side, child in zip((True, False), node.children, strict=True):
            share = tree[child].rows / node.rows if node.rows else 0.5
            open_.append((child, [*steps, (node.split, side, share)]))
    return out


def expected(paths: Sequence[Path]) -> float:
    """The margin with no feature known."""
    return float(sum(p.value * np.prod(p.shares) for p in paths))


def _satisfied(x: np.ndarray, taken: Sequence[tuple[Split, bool]]) -> np.ndarray:
    good = np.ones(len(x), bool)
    for split, left in taken:
        v = x[:, split.feature]
        goes = v <= split.threshold if split.threshold is not None else np.isin(v, list(split.left))
        good &= goes == left
    return good


def _of_pattern(known: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Per feature of a path its part of the leaf's value: ``known`` tells which ones the row satisfies."""
    d = len(shares)
    weights = np.array([factorial(s) * factorial(d - s - 1) / factorial(d) for s in range(d)])
    out = np.zeros(d)
    for i in range(d):
        c = np.array([1.0])
        for j in range(d):
            if j != i:
                c = np.convolve(c, (shares[j], known[j]))
        out[i] = (known[i] - shares[i]) * (c @ weights[: len(c)])
    return out


def shapley_rows(x: np.ndarray, paths: Sequence[Path]) -> np.ndarray:
    """(row, feature) Shapley values of the margin."""
    out = np.zeros(x.shape)
    for p in paths:
        if not p.features or not p.value:
            continue
        known = np.stack([_satisfied(x, t) for t in p.taken], axis=1)
        patterns, of = np.unique(known, axis=0, return_inverse=True)
        parts = np.stack([_of_pattern(k.astype(float), p.shares) for k in patterns])
        out[:, p.features] += p.value * parts[of.ravel()]
    return out


def shapley(model: GBTClassificationModel, df: DataFrame, names: Sequence[str], vector: str = "features") -> DataFrame:
    """``df`` with ``attribution`` (a struct of one value per feature), ``base`` and ``margin``.

    ``base`` and the values add up to the margin, the log odds of the positive class halved, row by row.
    """
    spark = df.sparkSession
    paths = [p for tree in read_trees(spark, model) for p in leaf_paths(tree)]
    base = expected(paths)
    shared = spark.sparkContext.broadcast(paths)  # the model
    kind = ", ".join(f"`{n}`: double" for n in names)

    @F.arrow_udf(f"struct<{kind}>")
    def attribute(vectors: pa.Array) -> pa.Array:
        flat = vectors.flatten().to_numpy(zero_copy_only=False)
        values = shapley_rows(flat.reshape(len(vectors), -1), shared.value) if len(vectors) else np.zeros((0, len(names)))
        return pa.StructArray.from_arrays([pa.array(values[:, i]) for i in range(len(names))], names=list(names))

    scored = df if "rawPrediction" in df.columns else model.transform(df)
    return scored.withColumns({
        "attribution": attribute(vector_to_array(vector)), "base": F.lit(base),
        "margin": vector_to_array("rawPrediction")[1],
    })


def mean_attribution(attributed: DataFrame, names: Sequence[str]) -> DataFrame:
    """Mean size of a feature's values over all rows, largest first."""
    sums = attributed.agg(*[F.avg(F.abs(F.col("attribution")[n])).alias(n) for n in names])
    rows = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("importance")) for n in names])
    return sums.select(F.inline(rows)).orderBy(F.desc("importance"), "feature")
