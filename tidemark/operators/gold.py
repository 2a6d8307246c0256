"""Gold tables: daily revenue, RFM and monthly KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.functions import values as V
from tidemark.operators.ranking import Key, tile_ends_many, tile_of
from tidemark.operators.relational import last_days
from tidemark.session import stable


def approved(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status").isin(*V.VALID_STATUSES))


def daily_revenue(df: DataFrame) -> DataFrame:
    """Revenue per customer, product, day and channel."""
    keys = [
        "id_cliente",
        "produto",
        F.col("ano_transacao").alias("ano"),
        F.col("mes_transacao").alias("mes"),
        F.col("dia_transacao").alias("dia"),
        F.to_date("dt_transacao").alias("dt_ref"),
        "canal",
        "is_digital",
    ]
    total, n = F.sum(C.cents("valor")), F.count("id_transacao")
    return df.groupBy(*keys).agg(
        C.from_cents(total).alias("receita_total"),
        n.alias("qtd_transacoes"),
        C.mean_from_cents(total, F.count("valor")).alias("ticket_medio"),
        C.money_round(F.max("valor")).alias("maior_transacao"),
        C.money_round(F.min("valor")).alias("menor_transacao"),
    )


#: Days of purchases the RFM table looks at.
RFM_DAYS = 365


def rfm_base(df: DataFrame, ref: str, days: int = RFM_DAYS) -> DataFrame:
    """Days since the last purchase, purchases and spend per customer."""
    return (
        last_days(df, "dt_transacao", ref, days)
        .groupBy("id_cliente")
        .agg(
            F.datediff(F.lit(ref).cast("date"), F.max("dt_transacao").cast("date")).alias("recency_dias"),
            F.count("id_transacao").alias("frequency"),
            C.from_cents(F.sum(C.cents("valor"))).alias("monetary"),
        )
    )


# Quintile orders: fewer days, more purchases and more spend score higher.
RFM_ORDERS = {
    "r_score": [Key("recency_dias", descending=True), Key("id_cliente")],
    "f_score": [Key("frequency"), Key("id_cliente")],
    "m_score": [Key("monetary"), Key("id_cliente")],
}


def rfm(df: DataFrame, ref: str, days: int = RFM_DAYS, specific_first: bool = False) -> DataFrame:
    """RFM scores and segment per customer.

    The per-customer base is computed once. Quintiles need three narrow sorts of it; the
    labels are then a projection, so the result itself is not shuffled again.
    """
    base = stable(rfm_base(df, ref, days))
    ends = tile_ends_many(base, 5, list(RFM_ORDERS.values()))
    scores = {out: tile_of(e, order) for (out, order), e in zip(RFM_ORDERS.items(), ends)}
    return (
        base.withColumns(scores)
        .withColumn("rfm_score", C.rfm_total("r_score", "f_score", "m_score"))
        .withColumn("segmento", C.segment("r_score", "f_score", "rfm_score", specific_first))
        .withColumn("dt_calculo", F.lit(ref).cast("date"))
    )


def monthly_totals(df: DataFrame) -> DataFrame:
    total = F.sum(C.cents("valor"))
    return df.groupBy("ano_transacao", "mes_transacao").agg(
        C.from_cents(total).alias("receita_mes"),
        F.count("id_transacao").alias("volume_mes"),
        C.mean_from_cents(total, F.count("valor")).alias("ticket_medio_mes"),
        F.countDistinct("id_cliente").alias("clientes_ativos"),
    )


def monthly_kpis(df: DataFrame, ref: str) -> DataFrame:
    """Monthly totals with growth against the previous month and the same month a year ago."""
    return kpis_of(monthly_totals(df), ref)


def kpis_of(totals: DataFrame, ref: str) -> DataFrame:
    """The KPIs of :func:`monthly_totals`, which may be stored and renewed month by month.

    Every month also offers its revenue to the month after it and to the month twelve
    later, so one grouping replaces two self-joins and gaps in the calendar give nulls.
    """
    month = F.col("ano_transacao") * 12 + F.col("mes_transacao")
    offered = totals.select(
        "*", month.alias("__own"), F.explode(F.array(F.lit(0), F.lit(1), F.lit(12))).alias("__lag")
    )
    at = {lag: F.col("__lag") == lag for lag in (0, 1, 12)}
    own = ["ano_transacao", "mes_transacao", "receita_mes", "volume_mes", "ticket_medio_mes", "clientes_ativos"]
    merged = offered.groupBy((F.col("__own") + F.col("__lag")).alias("__month")).agg(
        *[F.max(F.when(at[0], F.col(c))).alias(c) for c in own],
        F.max(F.when(at[1], F.col("receita_mes"))).alias("receita_mes_anterior"),
        F.max(F.when(at[12], F.col("receita_mes"))).alias("receita_mesmo_mes_ano_anterior"),
    )
    return (
        merged.filter(F.col("ano_transacao").isNotNull())
        .drop("__month")
        .withColumn("mom_receita_pct", C.pct_change("receita_mes", "receita_mes_anterior"))
        .withColumn("yoy_receita_pct", C.pct_change("receita_mes", "receita_mesmo_mes_ano_anterior"))
        .withColumn("dt_calculo", F.lit(ref).cast("date"))
    )


def latest_months(kpis: DataFrame, n: int = 3) -> DataFrame:
    return (
        kpis.orderBy(F.desc("ano_transacao"), F.desc("mes_transacao"))
        .select(
            "ano_transacao", "mes_transacao", "receita_mes",
            "mom_receita_pct", "yoy_receita_pct", "clientes_ativos",
        )
        .limit(n)
    )
