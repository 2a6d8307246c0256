"""The star-schema test tables seen as transactions, orders, dirty events and so on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.relational import dedup_latest
from tidemark.operators.scd import Versions

# How priorities and states of orders read as channels and states of transactions.
PRIORITY_CHANNEL = {
    "1-URGENT": " app",
    "2-HIGH": "Web ",
    "3-MEDIUM": "api",
    "4-NOT SPECIFIED": "loja",
    "5-LOW": " telefone ",
}
ORDER_STATUS = {"F": "aprovado ", "O": "Concluido", "P": " pendente"}

EVENT_VERSIONS = Versions("user_id", ["event_type"], "ts", ["event_id"])


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def _mapped(c: str, mapping: dict[str, str]) -> Column:
    chain = F
    for key, value in mapping.items():
        chain = chain.when(F.col(c) == key, value)
    return chain.otherwise(F.col(c))


def customer_id(c: str) -> Column:
    return F.concat(F.lit("C-"), F.lpad(F.col(c).cast("string"), 9, "0"))


def _order_columns() -> list[Column]:
    return [
        customer_id("o_custkey").alias("id_cliente"),
        F.col("o_orderdate").alias("dt_transacao"),
        _mapped("o_orderpriority", PRIORITY_CHANNEL).alias("canal"),
        _mapped("o_orderstatus", ORDER_STATUS).alias("status"),
    ]


def latest_lines(spark: SparkSession, root: str) -> DataFrame:
    """One line item per order and line number, the last one shipped."""
    order = [
        F.desc("l_shipdate"), "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    ]
    return dedup_latest(table(spark, root, "lineitem"), ["l_orderkey", "l_linenumber"], order)


def transactions(spark: SparkSession, root: str, lines: DataFrame | None = None) -> DataFrame:
    """Raw transactions: line items (all of them unless given) with their order and part."""
    lines = table(spark, root, "lineitem") if lines is None else lines
    return (
        lines.join(table(spark, root, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, root, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
            .alias("id_transacao"),
            F.col("l_extendedprice").alias("valor"),
            F.lower("p_type").alias("produto"),
            *_order_columns(),
            F.col("l_shipdate").alias("_ingestion_time"),
        )
    )


def orders_tx(spark: SparkSession, root: str) -> DataFrame:
    """One transaction per order."""
    return table(spark, root, "orders").select(
        F.col("o_orderkey").cast("string").alias("id_transacao"),
        F.col("o_totalprice").alias("valor"),
        F.lit("pedido").alias("produto"),
        *_order_columns(),
    )


def events_dirty(spark: SparkSession, root: str) -> DataFrame:
    """Events as raw transactions where some ids and amounts are missing or negative."""
    n = F.col("event_id")
    amount = F.when(n % 89 == 0, F.lit(None)).when(n % 83 == 0, -F.col("value")).otherwise(F.col("value"))
    return table(spark, root, "events").select(
        F.when(n % 97 != 0, n.cast("string")).alias("id_transacao"),
        F.concat(F.lit("U-"), F.col("user_id").cast("string")).alias("id_cliente"),
        amount.alias("valor"),
        F.col("ts").alias("dt_transacao"),
        F.col("event_type").alias("produto"),
    )


def access_log(spark: SparkSession, root: str) -> DataFrame:
    """Events as access-log rows with nested identity and request."""
    kind = F.col("event_type")
    action = F.when(kind == "view", "selectFromTable").when(kind == "click", "readFromTable").otherwise(kind)
    layer = F.when(F.col("user_id") % 2 == 0, "silver.transacoes").otherwise("gold.rfm_clientes")
    return table(spark, root, "events").select(
        F.struct(F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("@example.org")).alias("email"))
        .alias("user_identity"),
        F.col("ts").alias("event_time"),
        F.struct(layer.alias("table_full_name")).alias("request_params"),
        action.alias("action_name"),
        F.concat(F.lit("10.0.0."), (F.col("event_id") % 256).cast("string")).alias("source_ip_address"),
    )
