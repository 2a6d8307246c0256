"""Exact ranking and classification metrics, for one model or many at once.

``by`` names columns that separate the models; scores of all of them share one sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import Key, running_sums
from tidemark.operators.sizes import small

_ONE = "__one"


def _by_score(df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    """Positives and negatives per distinct score."""
    return df.groupBy(*by, F.col(score).alias("__score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"),
        F.count_if(F.col(label) != 1).alias("neg"),
    )


def _ranked(df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    """Score levels from high to low with running positives and negatives over all models."""
    order = [*by, Key("__score", descending=True)]
    # The sums lie in a checkpoint, so every metric reads them again without a shuffle.
    return running_sums(_by_score(df, label, score, by), order, {"cum_pos": "pos", "cum_neg": "neg"})


def _auc(ranked: DataFrame, by: Sequence[str]) -> DataFrame:
    pos, neg = F.sum("pos").cast("double"), F.sum("neg").cast("double")
    # Negatives ranked behind a level: those of this model end at its largest running total.
    lost = F.sum(F.col("pos").cast("double") * (F.col("cum_neg") - F.col("neg") / 2))
    wins = pos * F.max("cum_neg") - lost
    return ranked.groupBy(*by).agg(F.try_divide(wins, pos * neg).alias("auc"))


def _average_precision(ranked: DataFrame, by: Sequence[str]) -> DataFrame:
    # Running totals span all models: what came before one is its smallest value.
    start = ranked.groupBy(*by).agg(
        F.min(F.col("cum_pos") - F.col("pos")).alias("pos0"),
        F.min(F.col("cum_neg") - F.col("neg")).alias("neg0"),
        F.sum("pos").alias("total"),
    )
    found = (F.col("cum_pos") - F.col("pos0")).cast("double")
    seen = found + F.col("cum_neg") - F.col("neg0")
    gain = F.sum(F.col("pos") * F.try_divide(found, seen))
    return (
        ranked.join(small(start), list(by))
        .groupBy(*by)
        .agg(F.try_divide(gain, F.max("total").cast("double")).alias("average_precision"))
    )


def _keyed(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    return (df, list(by)) if by else (df.withColumn(_ONE, F.lit(0)), [_ONE])


def auc_rank(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve as the share of (positive, negative) pairs in right order.

    Equal scores count half; null when a class is absent.
    """
    df, keys = _keyed(df, by)
    return _auc(_ranked(df, label, score, keys), keys).drop(_ONE)


def average_precision(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Sum over score levels of the recall gained times the precision reached."""
    df, keys = _keyed(df, by)
    return _average_precision(_ranked(df, label, score, keys), keys).drop(_ONE)


def confusion_metrics(
    df: DataFrame, label: str = "label", score: str = "score", cut: float = 0.5, by: Sequence[str] = ()
) -> DataFrame:
    """Precision, recall and F1 at a cut, 0 where undefined."""
    real, said = F.col(label) == 1, F.col(score) >= cut
    counts = df.groupBy(*by).agg(
        F.count_if(real & said).alias("tp"),
        F.count_if(~real & said).alias("fp"),
        F.count_if(real & ~said).alias("fn"),
        F.count_if(~real & ~said).alias("tn"),
    )
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        *by, "tp", "fp", "fn", "tn",
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def all_metrics(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """One row per model: auc, average precision, precision, recall, F1."""
    df, keys = _keyed(df, by)
    ranked = _ranked(df, label, score, keys)
    at_cut = confusion_metrics(df, label, score, by=keys).drop("tp", "fp", "fn", "tn")
    return _auc(ranked, keys).join(_average_precision(ranked, keys), keys).join(at_cut, keys).drop(_ONE)
