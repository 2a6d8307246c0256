"""Column expressions shared by the layers. All stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalised(c: ColumnLike) -> Column:
    """Categorical text without outer spaces, in upper case."""
    return F.upper(F.trim(col(c)))


def standardise(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: normalised(c) for c in cols})


def clean_id(c: ColumnLike) -> Column:
    """Only letters and digits are kept."""
    return F.regexp_replace(col(c), "[^A-Za-z0-9]", "")


def money_round(c: ColumnLike) -> Column:
    return F.round(col(c), 2)


def cents(c: ColumnLike) -> Column:
    """Amount with two decimals as whole cents: sums are exact and need no ordering."""
    return F.round(col(c) * 100).cast("bigint")


def from_cents(c: ColumnLike) -> Column:
    return col(c).cast("double") / 100


def mean_from_cents(total: ColumnLike, n: ColumnLike) -> Column:
    """Average of cents as money, half away from zero, in integer arithmetic."""
    total, n = col(total), col(n)
    magnitude = F.call_function("div", 2 * F.abs(total) + n, 2 * n)
    return F.when(n > 0, F.signum(total.cast("double")) * magnitude / 100)


def date_parts(ts: ColumnLike) -> dict[str, Column]:
    ts = col(ts)
    return {
        "ano_transacao": F.year(ts),
        "mes_transacao": F.month(ts),
        "dia_transacao": F.dayofmonth(ts),
        "hora_transacao": F.hour(ts),
    }


def band(c: ColumnLike, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the half-open interval that holds the value; null for null and NaN."""
    c = col(c)
    picked = F.when(F.isnan(c), F.lit(None))
    for edge, label in zip(edges, labels):
        picked = picked.when(c < edge, label)
    return picked.when(c >= edges[-1], labels[-1])


def pct_change(current: ColumnLike, base: ColumnLike) -> Column:
    """Growth in percent with two decimals; null without a base or with base zero."""
    current, base = col(current), col(base)
    return F.round(F.try_divide(current - base, base) * 100, 2)


def rfm_total(r: ColumnLike, f: ColumnLike, m: ColumnLike) -> Column:
    return col(r) * 100 + col(f) * 10 + col(m)


def segment(r: ColumnLike, f: ColumnLike, total: ColumnLike, specific_first: bool = False) -> Column:
    """Customer segment.

    By default the score thresholds are tested before the r/f profiles, which leaves
    ``Novo`` unreachable; ``specific_first`` tests the two profiles before them.
    """
    r, f, total = col(r), col(f), col(total)
    by_score = [(total >= 444, "Campeao"), (total >= 333, "Leal")]
    by_profile = [((r >= 4) & (f <= 2), "Novo"), ((r <= 2) & (f >= 4), "Em_Risco")]
    tests = by_profile + by_score if specific_first else by_score + by_profile
    chain = F
    for test, name in [*tests, (r <= 2, "Inativo")]:
        chain = chain.when(test, name)
    return chain.otherwise("Regular")


def churn_label(recency: ColumnLike, days: int = 30) -> Column:
    return F.when(col(recency) > days, 1).otherwise(0)
