"""Validity rules: split into accepted and quarantined rows with the first broken rule."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import values as V

REASON = "_motivo_quarentena"


@dataclass(frozen=True)
class Rule:
    """A row breaks the rule where ``broken`` is true; null counts as kept."""

    reason: str
    broken: Column

    def test(self) -> Column:
        return F.coalesce(self.broken, F.lit(False))


def ingest_rules(id_col: str = "id_transacao", amount: str = "valor") -> list[Rule]:
    """Id present, amount present, amount not negative. NaN is no amount."""
    return [
        Rule(V.REASON_NULL_ID, F.col(id_col).isNull()),
        Rule(V.REASON_NULL_AMOUNT, F.col(amount).isNull() | F.isnan(amount)),
        Rule(V.REASON_NEGATIVE, F.col(amount) < 0),
    ]


def presence_rules(id_col: str = "id_transacao", amount: str = "valor") -> list[Rule]:
    """The weaker set of the feed that has no sign test."""
    return ingest_rules(id_col, amount)[:2]


def first_broken(rules: Sequence[Rule]) -> Column:
    """Reason of the first broken rule, null for a valid row."""
    return F.coalesce(*[F.when(r.test(), F.lit(r.reason)) for r in rules])


def mark(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.withColumn(REASON, first_broken(rules))


def split_valid(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their reason): every row is in exactly one."""
    marked = mark(df, rules)
    reason = F.col(REASON)
    return marked.filter(reason.isNull()).drop(REASON), marked.filter(reason.isNotNull())


def verdict_counts() -> list[Column]:
    """Valid and rejected rows of a marked frame, for ``agg`` or ``observe``."""
    return [
        F.count_if(F.col(REASON).isNull()).alias("validos"),
        F.count_if(F.col(REASON).isNotNull()).alias("quarentena"),
    ]
