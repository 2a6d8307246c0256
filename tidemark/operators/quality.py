"""Data-quality suites: all checks of a suite from one grouping of the table.

Nulls are not evaluated, except by the not-null check.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import values as V


class GateError(RuntimeError):
    """A table is below its quality threshold."""


@dataclass(frozen=True)
class Check:
    """``fails`` is true for a failing value; None marks the uniqueness check."""

    name: str
    column: str
    fails: Column | None = None

    @property
    def on_rows(self) -> bool:
        return self.fails is not None


def not_null(c: str) -> Check:
    return Check("not_null", c, F.col(c).isNull())


def unique(c: str) -> Check:
    return Check("unique", c)


def between(c: str, low: object = None, high: object = None, as_date: bool = False) -> Check:
    """Closed range; a missing bound is open. ``as_date`` compares whole days."""
    value = F.col(c).cast("date") if as_date else F.col(c)
    outside = []
    for bound, beyond in ((low, lambda b: value < b), (high, lambda b: value > b)):
        if bound is not None:
            outside.append(beyond(F.lit(bound).cast("date") if as_date else F.lit(bound)))
    return Check("between", c, reduce(lambda a, b: a | b, outside, F.lit(False)))


def in_set(c: str, allowed: Sequence[object]) -> Check:
    return Check("in_set", c, ~F.col(c).isin(*allowed))


def length_between(c: str, low: int, high: int) -> Check:
    n = F.length(c)
    return Check("length_between", c, (n < low) | (n > high))


def silver_suite(today: str) -> list[Check]:
    """The 13 checks of current silver transactions."""
    return [
        *[not_null(c) for c in ("id_transacao", "id_cliente", "valor", "dt_transacao", "is_current")],
        unique("id_transacao"),
        between("valor", 0.01, 1_000_000),
        in_set("status", V.STATUSES),
        in_set("canal", V.CHANNELS),
        not_null("faixa_valor"),
        in_set("faixa_valor", V.BAND_LABELS),
        length_between("id_cliente", 5, 50),
        between("dt_transacao", "2020-01-01", today, as_date=True),
    ]


def rfm_suite() -> list[Check]:
    """The 11 checks of the RFM table."""
    return [
        *[not_null(c) for c in ("id_cliente", "segmento", "rfm_score")],
        *[between(c, 1, 5) for c in ("r_score", "f_score", "m_score")],
        between("rfm_score", 111, 555),
        in_set("segmento", V.SEGMENTS),
        between("recency_dias", 0, 3650),
        between("monetary", 0),
        between("frequency", 1),
    ]


# Entries that are no values: a failing row, a row that is not evaluated, any row.
_FAILS, _UNSEEN, _ROW = "f", "u", "r"


def _entries(checks: Sequence[tuple[int, Check]]) -> Column:
    """What a row adds to the counts: itself, the values that must be unique, and the checks it fails or skips.

    A good row adds no entry for its row checks, so hardly more is grouped than the unique values.
    """
    # Constant entries are parsed, as columns cost a call for every part of them.
    entry = lambda i, v: F.expr(f"named_struct('position', {i}, 'value', {v})")
    made = [entry(0, f"'{_ROW}'")]
    for i, check in checks:
        name = f"`{check.column}`"
        if not check.on_rows:
            made.append(F.expr(f"if({name} IS NOT NULL, named_struct('position', {i}, 'value', CAST({name} AS STRING)), NULL)"))
            continue
        fails = F.when(check.fails, entry(i, f"'{_FAILS}'"))
        made.append(fails if check.name == "not_null" else F.when(F.col(check.column).isNull(), entry(i, f"'{_UNSEEN}'")).otherwise(fails))
    return F.array_compact(F.array(*made))


def run_suite(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Rows (position, check, column, failing, evaluated, ok), one per check.

    The frame is computed once: rows give entries that are counted before their one shuffle, and only the values of
    the uniqueness checks are many.
    """
    numbered = list(enumerate(checks, 1))
    if not numbered:
        raise ValueError("a suite needs at least one check")
    counted = df.select(F.inline(_entries(numbered))).groupBy("position", "value").agg(F.count(F.lit(1)).alias("n"))
    named = lambda v: F.coalesce(F.sum(F.when(F.col("value") == v, F.col("n"))), F.lit(0))
    sums = counted.groupBy("position").agg(
        F.sum("n").alias("every"), named(_FAILS).alias("fails"), named(_UNSEEN).alias("unseen"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("repeated"),
    )
    # One entry per check.
    found = sums.agg(F.map_from_entries(F.collect_list(F.struct("position", F.struct("every", "fails", "unseen", "repeated")))).alias("m"))
    at = lambda i, c: f"coalesce(m[{i}].{c}, 0L)"
    text = lambda t: "'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'"
    rows = ", ".join(
        f"named_struct('position', {i}, 'check', {text(check.name)}, 'column', {text(check.column)}, "
        f"'failing', {at(i, 'fails' if check.on_rows else 'repeated')}, "
        f"'evaluated', {at(0, 'every') + ' - ' + at(i, 'unseen') if check.on_rows else at(i, 'every')})"
        for i, check in numbered
    )
    return found.selectExpr(f"inline(array({rows}))").withColumn("ok", F.col("failing") == 0)


def summarise(results: DataFrame, table: str, threshold: float, at: dt.datetime) -> DataFrame:
    """One log row per suite run; a suite without checks scores 0."""
    total, good = F.count(F.lit(1)), F.count_if(F.col("ok"))
    pct = F.coalesce(F.try_divide(good * F.lit(100.0), total), F.lit(0.0))
    # One entry per check of the suite, so the list is small.
    broken = F.array_sort(F.collect_list(
        F.when(~F.col("ok"), F.struct("position", "check", "column", "ok"))
    ))
    shown = F.transform(
        broken,
        lambda b: F.struct(
            b["check"].alias("expectation"), b["column"].alias("coluna"), b["ok"].alias("sucesso")
        ),
    )
    return results.agg(
        F.lit(table).alias("tabela"),
        F.lit(at).alias("dt_execucao"),
        total.alias("total_checks"),
        good.alias("checks_ok"),
        (total - good).alias("checks_falha"),
        F.round(pct, 2).alias("pct_qualidade"),
        (pct >= threshold).alias("passou_threshold"),
        F.to_json(shown).alias("falhas_json"),
    )


def failures(summaries: DataFrame) -> DataFrame:
    """Summaries below their threshold."""
    return summaries.filter(~F.col("passou_threshold"))


def gate(summaries: DataFrame) -> None:
    """Raise when any table of the summaries is below its threshold."""
    failed = [r["tabela"] for r in failures(summaries).select("tabela").collect()]
    if failed:
        raise GateError(f"{len(failed)} table(s) below the quality threshold: {sorted(failed)}")
