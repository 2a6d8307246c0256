"""The registered queries: every operator over the whole test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import columns as C
from tidemark.functions import values as V
from tidemark.operators import churn, gold, layout, metrics, prompts, quality, ranking, relational, retrieval, rules, scd
from tidemark.operators.ranking import Key
from tidemark.operators.silver import SILVER_VERSIONS, cleanse
from tidemark.plans import oracles as O
from tidemark.plans.maintenance import GOLD_CLUSTERING, maintain
from tidemark.plans.medallion import Feed, Lakehouse
from tidemark.session import run_dir
from tidemark.sources import files, sinks
from tidemark.sources import views as W
from tidemark.sources.snapshots import SnapshotTable
from tidemark.sources.versions import VersionStore
from tidemark.streaming.ingest import run_ingest

REF = "2001-08-01"
SPLIT = "2024-01-15"
TODAY = "2024-06-30"
AT = dt.datetime(2024, 6, 30, 12)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function name, with the statement that checks it."""

    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


# --- shared frames --------------------------------------------------------------------


def silver_frame(spark: SparkSession, d: str) -> DataFrame:
    return cleanse(W.transactions(spark, d, W.latest_lines(spark, d)))


def order_frame(spark: SparkSession, d: str) -> DataFrame:
    return gold.approved(cleanse(W.orders_tx(spark, d)))


def rfm_frame(spark: SparkSession, d: str) -> DataFrame:
    return gold.rfm(order_frame(spark, d), REF)


def events(spark: SparkSession, d: str) -> DataFrame:
    return W.table(spark, d, "events")


# --- bronze ---------------------------------------------------------------------------


@query(f"WITH {O.raw('lineitem')} SELECT * FROM raw")
def bronze_transactions(spark, d):
    return W.transactions(spark, d)


@query(f"WITH {O.ORDERS_RAW} SELECT * FROM raw WHERE dt_transacao >= DATE '{REF}' - INTERVAL 90 DAY")
def bronze_backfill(spark, d):
    return relational.backfill(W.orders_tx(spark, d), "dt_transacao", REF, 90)


@query(f"SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '{SPLIT}'")
def bronze_read_since(spark, d):
    return relational.read_since(events(spark, d), "ts", dt.datetime(2024, 1, 10), dt.datetime.fromisoformat(SPLIT))


@query(f"""WITH {O.raw('lineitem')}, {O.DIRTY}
SELECT _cloud_origem, count(*) AS n, count(canal) AS com_canal FROM (
  SELECT 'azure' AS _cloud_origem, canal FROM raw
  UNION ALL SELECT 'aws', o_orderpriority FROM orders
  UNION ALL SELECT NULL, NULL FROM dirty)
GROUP BY _cloud_origem""")
def bronze_union_sources(spark, d):
    feeds = relational.union_sources(
        W.transactions(spark, d).withColumn("_cloud_origem", F.lit("azure")),
        W.orders_tx(spark, d).withColumn("_cloud_origem", F.lit("aws")),
        W.events_dirty(spark, d),
    )
    return feeds.groupBy("_cloud_origem").agg(F.count(F.lit(1)).alias("n"), F.count("canal").alias("com_canal"))


@query(f"WITH {O.DIRTY} SELECT * EXCLUDE (_motivo_quarentena) FROM judged WHERE _motivo_quarentena IS NULL")
def ingest_valid(spark, d):
    return rules.split_valid(W.events_dirty(spark, d), rules.ingest_rules())[0]


@query(f"WITH {O.DIRTY} SELECT * FROM judged WHERE _motivo_quarentena IS NOT NULL")
def ingest_quarantine(spark, d):
    return rules.split_valid(W.events_dirty(spark, d), rules.ingest_rules())[1]


@query(f"""WITH {O.DIRTY} SELECT count(*) FILTER (WHERE _motivo_quarentena IS NULL) AS validos,
count(*) FILTER (WHERE _motivo_quarentena IS NOT NULL) AS quarentena FROM judged""")
def ingest_counts(spark, d):
    return rules.mark(W.events_dirty(spark, d), rules.ingest_rules()).agg(*rules.verdict_counts())


@query(f"""WITH {O.DIRTY} SELECT * EXCLUDE (_motivo_quarentena) FROM judged
WHERE id_transacao IS NOT NULL AND valor IS NOT NULL""")
def ingest_presence_only(spark, d):
    return rules.split_valid(W.events_dirty(spark, d), rules.presence_rules())[0]


def _ingested(spark: SparkSession, d: str) -> str:
    """Streams the events file into fresh tables, twice: the second run finds nothing new."""
    out = run_dir(spark, "ingest")
    # A pattern, since the source may be one file or a folder of files.
    path = f"{d.rstrip('/')}/events.parque[t]"
    schema = events(spark, d).schema

    def prepare(batch: DataFrame) -> DataFrame:
        n = F.col("event_id")
        return batch.select(
            F.when(n % 97 != 0, n.cast("string")).alias("id_transacao"),
            F.when(n % 83 == 0, -F.col("value")).otherwise(F.col("value")).alias("valor"),
            F.col("ts").alias("dt_transacao"),
            "_cloud_origem",
        )

    for _ in range(2):
        stream = files.with_lineage(files.stream_files(spark, path, "parquet", schema), "gcp")
        run_ingest(stream, rules.ingest_rules(), f"{out}/ok", f"{out}/rejected", f"{out}/checkpoint", prepare)
    return out


_STREAMED = """
streamed AS (
  SELECT CASE WHEN event_id % 97 <> 0 THEN CAST(event_id AS VARCHAR) END AS id_transacao,
    CASE WHEN event_id % 83 = 0 THEN -value ELSE value END AS valor, ts AS dt_transacao,
    'gcp' AS _cloud_origem FROM events
)"""


@query(f"WITH {_STREAMED} SELECT * FROM streamed WHERE id_transacao IS NOT NULL AND valor >= 0")
def ingest_stream_accepted(spark, d):
    return sinks.read_merged(spark, f"{_ingested(spark, d)}/ok").drop("batch_id")


@query(f"""WITH {_STREAMED} SELECT *, CASE WHEN id_transacao IS NULL THEN 'id_transacao nulo'
ELSE 'valor negativo' END AS _motivo_quarentena FROM streamed WHERE id_transacao IS NULL OR valor < 0""")
def ingest_stream_quarantine(spark, d):
    return sinks.read_merged(spark, f"{_ingested(spark, d)}/rejected").drop("batch_id")


@query("""SELECT event_id, 'aws' AS _cloud_origem, true AS from_a_file, true AS in_time,
event_id % 2 AS part FROM events""")
def ingest_lineage(spark, d):
    """Events written to two folders and read back with their lineage: the file named is the one that holds the row."""
    root = run_dir(spark, "lineage")
    rows = events(spark, d).select("event_id", (F.col("event_id") % 2).alias("part"))
    rows.write.partitionBy("part").parquet(f"{root}/raw")
    known = files.with_lineage(spark.read.parquet(f"{root}/raw"), "aws")
    return known.select(
        "event_id", "_cloud_origem", F.col("_source_file").rlike(r"/raw/part=\d/[^/]+\.parquet$").alias("from_a_file"),
        F.col("_ingestion_time").between(F.lit("2024-01-01").cast("timestamp"), F.current_timestamp()).alias("in_time"),
        F.regexp_extract("_source_file", r"part=(\d)", 1).cast("long").alias("part"),
    )


@query("""SELECT event_id, CASE event_type WHEN 'view' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
CASE event_type WHEN 'view' THEN NULL WHEN 'click' THEN NULL
  WHEN 'error' THEN '{"k":"x' || json_extract_string(props, '$.k') || '"}'
  ELSE '{"other":"' || json_extract_string(props, '$.k') || '"}' END AS _rescue,
CASE event_type WHEN 'click' THEN 'x' || props END AS _corrupt FROM events""")
def ingest_rescue(spark, d):
    number = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    text = (
        F.when(kind == "view", F.col("props"))
        .when(kind == "click", F.concat(F.lit("x"), F.col("props")))
        .when(kind == "error", F.concat(F.lit('{"k": "x'), number, F.lit('"}')))
        .otherwise(F.concat(F.lit('{"other": '), number, F.lit("}")))
    )
    return files.with_rescue(events(spark, d).select("event_id", text.alias("value")), "k bigint")


@query(f"""SELECT * EXCLUDE (props), CASE WHEN ts >= TIMESTAMP '{SPLIT}' THEN props END AS props,
CASE WHEN ts >= TIMESTAMP '{SPLIT}' THEN 1 ELSE 0 END::BIGINT AS batch_id FROM events""")
def ingest_schema_growth(spark, d):
    """Two batches, the second with one more column and written twice."""
    path = run_dir(spark, "growth")
    old, new = _split(spark, d)
    sinks.append_batch(old.drop("props"), path, 0)
    for _ in range(2):
        sinks.append_batch(new, path, 1)
    return sinks.read_merged(spark, path).withColumn("batch_id", F.col("batch_id").cast("long"))


@query("SELECT event_type AS job, max(ts) AS mark FROM events GROUP BY event_type")
def ingest_high_water(spark, d):
    marks = files.HighWater(spark, run_dir(spark, "marks"))
    newest = events(spark, d).groupBy(F.col("event_type").alias("job")).agg(F.max("ts").alias("mark"))
    marks.advance_all(newest.withColumn("mark", F.col("mark").cast("timestamp") - F.expr("INTERVAL 1 DAY")))
    marks.advance_all(newest)
    return marks.marks().withColumn("mark", F.col("mark").cast("timestamp_ntz"))


# --- silver ---------------------------------------------------------------------------


@query(f"WITH {O.LINES} SELECT * FROM lines")
def silver_dedup(spark, d):
    return W.latest_lines(spark, d)


@query(f"{O.SILVER_TX} SELECT * FROM silver")
def silver_transactions(spark, d):
    return silver_frame(spark, d)


@query(f"{O.SILVER_TX} SELECT faixa_valor, is_digital, count(*) AS n FROM silver GROUP BY ALL")
def silver_band_counts(spark, d):
    return relational.count_by(silver_frame(spark, d), "faixa_valor", "is_digital")


@query(f"""{O.SILVER_TX} SELECT *, dt_transacao AS dt_inicio, CAST(NULL AS TIMESTAMP) AS dt_fim,
true AS is_current FROM silver""")
def silver_first_load(spark, d):
    return scd.scd2_init(silver_frame(spark, d), SILVER_VERSIONS)


@query(f"""{O.SILVER_TX} SELECT id_transacao, id_cliente, valor, dt_transacao, produto, canal, status, faixa_valor,
is_digital, ano_transacao, mes_transacao, dia_transacao, hora_transacao, dt_transacao AS dt_inicio,
CAST(NULL AS TIMESTAMP) AS dt_fim, true AS is_current, CAST(NULL AS VARCHAR) AS _source_file, _ingestion_time,
CAST(NULL AS VARCHAR) AS _cloud_origem FROM silver""")
def silver_conform(spark, d):
    contract = T.StructType.fromDDL(V.SILVER_SCHEMA)
    # The test tables carry times without a zone; the contract is applied in kind.
    local = T.StructType([
        T.StructField(f.name, T.TimestampNTZType() if f.dataType == T.TimestampType() else f.dataType)
        for f in contract
    ])
    return relational.conform(scd.scd2_init(silver_frame(spark, d), SILVER_VERSIONS), local)


@query(f"WITH {O.history('events')} SELECT * FROM versions")
def scd2_history(spark, d):
    return scd.scd2_history(events(spark, d), W.EVENT_VERSIONS)


def _split(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = events(spark, d)
    return rows.filter(F.col("ts") < SPLIT), rows.filter(F.col("ts") >= SPLIT)


def _applied(spark: SparkSession, d: str) -> scd.Applied:
    old, new = _split(spark, d)
    first = scd.current(scd.scd2_history(old, W.EVENT_VERSIONS), W.EVENT_VERSIONS)
    return scd.scd2_apply(first, new, W.EVENT_VERSIONS)


@query(f"WITH {O.history('events')} SELECT * FROM versions WHERE is_current")
def scd2_apply_current(spark, d):
    return _applied(spark, d).current


@query(f"WITH {O.history('events')} SELECT * FROM versions WHERE dt_fim >= TIMESTAMP '{SPLIT}'")
def scd2_apply_closed(spark, d):
    return _applied(spark, d).closed


@query(f"""WITH later AS (SELECT * FROM events WHERE ts >= TIMESTAMP '{SPLIT}'), {O.history('later')}
SELECT e.* FROM events e JOIN versions v ON e.user_id = v.user_id AND v.is_current AND e.ts <= v.dt_inicio
WHERE e.ts < TIMESTAMP '{SPLIT}'""")
def scd2_apply_late(spark, d):
    old, new = _split(spark, d)
    newest = scd.current(scd.scd2_history(new, W.EVENT_VERSIONS), W.EVENT_VERSIONS)
    return scd.scd2_apply(newest, old, W.EVENT_VERSIONS).late


@query(f"WITH {O.history('events')} SELECT * FROM versions")
def scd2_store(spark, d):
    """The history after two batches through the appended store, folded in between."""
    store = VersionStore(spark, run_dir(spark, "versions"), W.EVENT_VERSIONS, buckets=8)
    old, new = _split(spark, d)
    store.apply(old)
    store.fold()
    store.apply(new)
    return store.history()


@query(f"""WITH {O.history('events')} SELECT * FROM versions
WHERE dt_inicio <= TIMESTAMP '{SPLIT}' AND (dt_fim IS NULL OR dt_fim > TIMESTAMP '{SPLIT}')""")
def scd2_as_of(spark, d):
    return scd.as_of(scd.scd2_history(events(spark, d), W.EVENT_VERSIONS), W.EVENT_VERSIONS, SPLIT)


@query(f"WITH {O.history('events')} SELECT event_type, is_current, count(*) AS n FROM versions GROUP BY ALL")
def scd2_summary(spark, d):
    history = scd.scd2_history(events(spark, d), W.EVENT_VERSIONS)
    return scd.scd2_summary(history, W.EVENT_VERSIONS, "event_type")


@query(f"{O.SILVER_TX} SELECT faixa_valor, true AS is_current, count(*) AS n FROM silver GROUP BY faixa_valor")
def scd2_summary_by_band(spark, d):
    return scd.scd2_summary(scd.scd2_init(silver_frame(spark, d), SILVER_VERSIONS), SILVER_VERSIONS, "faixa_valor")


@query(f"""WITH {O.history('events')} SELECT count(*) AS total, count(*) FILTER (WHERE is_current) AS correntes,
count(*) FILTER (WHERE NOT is_current) AS historico FROM versions""")
def scd2_totals(spark, d):
    history = scd.scd2_history(events(spark, d), W.EVENT_VERSIONS)
    return history.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("is_current").alias("correntes"),
        F.count_if(~F.col("is_current")).alias("historico"),
    )


# --- global order ---------------------------------------------------------------------

_PRICE = [Key("l_extendedprice", descending=True), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]


@query("""WITH t AS (SELECT l_extendedprice, ntile(5) OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber,
  l_partkey, l_suppkey, l_shipdate) AS tile FROM lineitem)
SELECT CAST(tile AS INTEGER) AS tile, count(*) AS n, min(l_extendedprice) AS low, max(l_extendedprice) AS high
FROM t GROUP BY tile""")
def rank_price_quintiles(spark, d):
    return ranking.ntile_global(W.table(spark, d, "lineitem"), 5, _PRICE, "tile").groupBy("tile").agg(
        F.count(F.lit(1)).alias("n"), F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high")
    )


@query("""SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS posicao FROM orders""")
def rank_row_numbers(spark, d):
    rows = W.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return ranking.number_rows(rows, ["o_totalprice", "o_orderkey"], "posicao").select("o_orderkey", "posicao")


@query("""SELECT o_orderkey, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (ORDER BY o_orderdate, o_orderkey)
AS BIGINT) AS acumulado FROM orders""")
def rank_running_sums(spark, d):
    rows = W.table(spark, d, "orders").select("o_orderkey", "o_orderdate", C.cents("o_totalprice").alias("centavos"))
    return ranking.running_sums(rows, ["o_orderdate", "o_orderkey"], {"acumulado": "centavos"}).select(
        "o_orderkey", "acumulado"
    )


# --- gold -----------------------------------------------------------------------------


@query(f"""{O.SILVER_TX} SELECT id_cliente, produto, ano_transacao AS ano, mes_transacao AS mes, dia_transacao AS dia,
CAST(dt_transacao AS DATE) AS dt_ref, canal, is_digital, {O.TOTAL} AS receita_total,
count(id_transacao) AS qtd_transacoes, {O.MEAN} AS ticket_medio, round(max(valor), 2) AS maior_transacao,
round(min(valor), 2) AS menor_transacao FROM ok GROUP BY ALL""")
def gold_daily_revenue(spark, d):
    return gold.daily_revenue(gold.approved(silver_frame(spark, d)))


@query(f"""{O.SILVER_ORDERS}, months AS (SELECT CAST(date_trunc('month', dt_transacao) AS DATE) AS dt_mes, id_cliente,
{O.TOTAL} AS receita FROM ok GROUP BY ALL)
SELECT dt_mes, id_cliente, CASE WHEN dt_mes = DATE '1998-03-01' THEN -receita ELSE receita END AS receita FROM months""")
def gold_slice_overwrite(spark, d):
    """All slices stored, then one replaced: the others stay."""
    path = run_dir(spark, "slices")
    months = order_frame(spark, d).groupBy(F.trunc("dt_transacao", "month").alias("dt_mes"), "id_cliente").agg(
        C.from_cents(F.sum(C.cents("valor"))).alias("receita")
    )
    sinks.overwrite(months, path, ["dt_mes"])
    sinks.replace_slice(months.withColumn("receita", -F.col("receita")), path, "dt_mes", "1998-03-01")
    return spark.read.parquet(path)


@query(f"{O.SILVER_ORDERS}, {O.rfm('ok', REF)} SELECT * FROM rfm")
def gold_rfm(spark, d):
    return rfm_frame(spark, d)


@query(f"""{O.SILVER_ORDERS}, {O.rfm('ok', REF)} SELECT * REPLACE (
CASE WHEN r_score >= 4 AND f_score <= 2 THEN 'Novo' WHEN r_score <= 2 AND f_score >= 4 THEN 'Em_Risco'
  WHEN rfm_score >= 444 THEN 'Campeao' WHEN rfm_score >= 333 THEN 'Leal' WHEN r_score <= 2 THEN 'Inativo'
  ELSE 'Regular' END AS segmento) FROM rfm""")
def gold_rfm_specific_segments(spark, d):
    return gold.rfm(order_frame(spark, d), REF, specific_first=True)


@query(f"{O.SILVER_ORDERS}, {O.rfm('ok', REF)} SELECT segmento, count(*) AS n FROM rfm GROUP BY segmento")
def gold_rfm_segments(spark, d):
    return relational.count_by(rfm_frame(spark, d), "segmento")


@query(f"{O.SILVER_ORDERS}, {O.KPIS} SELECT * FROM kpis")
def gold_kpis(spark, d):
    return gold.monthly_kpis(order_frame(spark, d), REF)


@query(f"""{O.SILVER_ORDERS}, {O.KPIS} SELECT ano_transacao, mes_transacao, receita_mes, mom_receita_pct,
yoy_receita_pct, clientes_ativos FROM kpis ORDER BY ano_transacao DESC, mes_transacao DESC LIMIT 3""")
def gold_kpis_latest(spark, d):
    return gold.latest_months(gold.monthly_kpis(order_frame(spark, d), REF))


@query(f"{O.SILVER_ORDERS}, {O.rfm('ok', REF)} SELECT * FROM rfm")
def gold_maintained(spark, d):
    """The RFM table after its upkeep: evenly sized, clustered files with the same rows."""
    folder = run_dir(spark, "gold")
    sinks.overwrite(rfm_frame(spark, d), f"{folder}/rfm_clientes", ["dt_calculo"])
    maintain(spark, folder, {"rfm_clientes": GOLD_CLUSTERING["rfm_clientes"]})
    return spark.read.parquet(f"{folder}/rfm_clientes")


@query(f"{O.SILVER_ORDERS}, {O.KPIS} SELECT * FROM kpis")
def gold_kpis_from_raw_files(spark, d):
    """Orders written as raw JSON files, ingested, refined into the history, and summed up."""
    root = run_dir(spark, "lake")
    W.orders_tx(spark, d).withColumn("dt_transacao", F.col("dt_transacao").cast("timestamp")).write.json(f"{root}/raw")
    lake = Lakehouse(spark, root, buckets=2)
    lake.ingest(Feed("pedidos", f"{root}/raw", tag="azure"))
    lake.refine(["pedidos"])
    return gold.monthly_kpis(gold.approved(lake.silver.current()), REF)


@query(f"""{O.SILVER_ORDERS}, {O.rfm('ok', REF)} SELECT CASE WHEN segmento <> 'Regular' THEN id_cliente END AS id_cliente,
rfm_score, segmento, CASE WHEN segmento = 'Regular' THEN 'id_cliente nulo' END AS falha FROM rfm""")
def gold_rfm_contract(spark, d):
    """Rows of the RFM table under its contract, after the ids of one segment were blanked: what a write would refuse."""
    rows = rfm_frame(spark, d).withColumn("id_cliente", F.when(F.col("segmento") != "Regular", F.col("id_cliente")))
    return relational.contract_breaks(rows, V.RFM_SCHEMA, "falha").select("id_cliente", "rfm_score", "segmento", "falha")


@query(f"{O.SILVER_ORDERS}, {O.KPIS} SELECT * FROM kpis")
def gold_kpis_from_states(spark, d):
    """KPIs from stored monthly totals, of which the second of two batches of orders renews only its months."""
    root = run_dir(spark, "lake")
    lake, feed = Lakehouse(spark, root, buckets=2), Feed("pedidos", f"{root}/raw", tag="azure")
    orders = W.orders_tx(spark, d).withColumn("dt_transacao", F.col("dt_transacao").cast("timestamp"))
    for part in (F.col("dt_transacao") < REF, F.col("dt_transacao") >= REF):
        orders.filter(part).write.mode("append").json(f"{root}/raw")
        lake.ingest(feed)
        lake.refine(["pedidos"])
        totals = lake.monthly_totals()
    return gold.kpis_of(totals, REF)


# --- data quality ---------------------------------------------------------------------

_SILVER_CURRENT = f"{O.SILVER_TX}, cur AS (SELECT *, true AS is_current FROM silver)"


def _silver_results(spark: SparkSession, d: str) -> DataFrame:
    current = scd.scd2_init(silver_frame(spark, d), SILVER_VERSIONS)
    return quality.run_suite(current, quality.silver_suite(TODAY))


@query(f"{_SILVER_CURRENT} {O.checks(O.SILVER_CHECKS, 'cur')}")
def dq_silver_suite(spark, d):
    return _silver_results(spark, d)


@query(f"{O.SILVER_ORDERS}, {O.rfm('ok', REF)} {O.checks(O.RFM_CHECKS, 'rfm')}")
def dq_rfm_suite(spark, d):
    return quality.run_suite(rfm_frame(spark, d), quality.rfm_suite())


_DIRTY_CHECKS = [
    ("not_null", "id_transacao", "true", "id_transacao IS NULL"),
    ("unique", "id_transacao", "", ""),
    ("unique", "id_cliente", "", ""),
    ("between", "valor", "valor IS NOT NULL", "valor < 0.01"),
]


@query(f"WITH {O.DIRTY} {O.checks(_DIRTY_CHECKS, 'dirty')}")
def dq_dirty_suite(spark, d):
    return quality.run_suite(W.events_dirty(spark, d), [
        quality.not_null("id_transacao"),
        quality.unique("id_transacao"),
        quality.unique("id_cliente"),
        quality.between("valor", 0.01),
    ])


@query(f"""{_SILVER_CURRENT}, s AS ({O.checks(O.SILVER_CHECKS, 'cur')}), {O.ORDERS_RAW.replace('raw AS', 'raw_o AS')},
clean_o AS (SELECT * REPLACE (upper(trim(status)) AS status,
  regexp_replace(id_cliente, '[^A-Za-z0-9]', '', 'g') AS id_cliente, round(valor, 2) AS valor) FROM raw_o
  WHERE upper(trim(status)) IN ('APROVADO', 'CONCLUIDO')),
{O.rfm('clean_o', REF)}, r AS ({O.checks(O.RFM_CHECKS, 'rfm')})
{O.summary('silver.transacoes', '2024-06-30 12:00:00', 95)} FROM s
UNION ALL {O.summary('gold.rfm_clientes', '2024-06-30 12:00:00', 95)} FROM r""")
def dq_summary(spark, d):
    rfm = quality.run_suite(rfm_frame(spark, d), quality.rfm_suite())
    both = quality.summarise(_silver_results(spark, d), "silver.transacoes", 95, AT).unionByName(
        quality.summarise(rfm, "gold.rfm_clientes", 95, AT)
    )
    return both.withColumn("dt_execucao", F.col("dt_execucao").cast("timestamp_ntz"))


@query(f"""{_SILVER_CURRENT}, s AS ({O.checks(O.SILVER_CHECKS, 'cur')}),
g AS ({O.summary('silver.transacoes', '2024-06-30 12:00:00', 95)} FROM s)
SELECT tabela, checks_falha, pct_qualidade FROM g WHERE NOT passou_threshold""")
def dq_gate_failures(spark, d):
    """What the gate would stop on."""
    summary = quality.summarise(_silver_results(spark, d), "silver.transacoes", 95, AT)
    return quality.failures(summary).select("tabela", "checks_falha", "pct_qualidade")


@query(f"""{_SILVER_CURRENT}, s AS ({O.checks(O.SILVER_CHECKS, 'cur')}),
g AS ({O.summary('silver.transacoes', '2024-06-30 12:00:00', 95)} FROM s)
SELECT tabela, total_checks, checks_ok, checks_falha, falhas_json, CAST(2 AS BIGINT) AS execucoes FROM g""")
def dq_results_appended(spark, d):
    """The log of two runs of one suite."""
    path = run_dir(spark, "results")
    summary = quality.summarise(_silver_results(spark, d), "silver.transacoes", 95, AT)
    rows = spark.createDataFrame(summary.collect(), summary.schema)  # one row per table
    for _ in range(2):
        sinks.append_results(rows, path)
    kept = ["tabela", "total_checks", "checks_ok", "checks_falha", "falhas_json"]
    return spark.read.parquet(path).groupBy(*kept).agg(F.count(F.lit(1)).alias("execucoes"))


# --- churn ----------------------------------------------------------------------------

_FEATURES = """SELECT id_cliente, recency_dias, frequency, monetary, r_score, f_score, m_score, rfm_score, segmento,
CASE WHEN recency_dias > 30 THEN 1 ELSE 0 END AS churn FROM rfm"""


@query(f"{O.SILVER_ORDERS}, {O.rfm('ok', REF)} {_FEATURES}")
def churn_features(spark, d):
    return churn.churn_features(rfm_frame(spark, d))


CUTOFF = "2001-06-01"


@query(f"""{O.SILVER_ORDERS}, {O.rfm('ok', CUTOFF, 180)}
SELECT id_cliente, recency_dias, frequency, monetary, r_score, f_score, m_score, rfm_score, segmento,
CASE WHEN id_cliente IN (SELECT id_cliente FROM ok WHERE dt_transacao >= DATE '{CUTOFF}' + INTERVAL 1 DAY
  AND dt_transacao < DATE '{CUTOFF}' + INTERVAL 31 DAY) THEN 0 ELSE 1 END AS churn FROM rfm""")
def churn_forward_features(spark, d):
    return churn.forward_features(order_frame(spark, d), CUTOFF)


@query(f"{O.SILVER_ORDERS}, {O.rfm('ok', REF)}, f AS ({_FEATURES}) SELECT avg(churn) AS taxa, count(*) AS linhas FROM f")
def churn_rate(spark, d):
    return churn.positive_rate(churn.churn_features(rfm_frame(spark, d)))


@query(f"""{O.SILVER_ORDERS}, {O.rfm('ok', REF)}
SELECT id_cliente, segmento, CAST(dense_rank() OVER (ORDER BY segmento) - 1 AS DOUBLE) AS segmento_enc FROM rfm""")
def churn_category_index(spark, d):
    return churn.index_col(rfm_frame(spark, d).select("id_cliente", "segmento"))


@query(f"""{O.SILVER_ORDERS}, {O.rfm('ok', REF)} SELECT id_cliente, CAST(recency_dias AS DOUBLE) AS f0,
CAST(frequency AS DOUBLE) AS f1, monetary AS f2, CAST(r_score AS DOUBLE) AS f3, CAST(f_score AS DOUBLE) AS f4,
CAST(m_score AS DOUBLE) AS f5, CAST(rfm_score AS DOUBLE) AS f6,
CAST(dense_rank() OVER (ORDER BY segmento) - 1 AS DOUBLE) AS f7 FROM rfm""")
def churn_assembled(spark, d):
    """The feature vector of every customer, place by place."""
    rows = churn.assemble(churn.index_col(rfm_frame(spark, d)))
    vector = vector_to_array("features")
    return rows.select("id_cliente", *[vector[i].alias(f"f{i}") for i in range(len(V.FEATURES))])


PARTS = {"train": 0.68, "val": 0.12, "test": 0.2}


@query(f"""{O.SILVER_ORDERS}, {O.rfm('ok', REF)}, f AS ({_FEATURES}),
n AS (SELECT churn, count(*) AS c FROM f GROUP BY churn)
SELECT churn, 'train' AS part, CAST(round_even(0.68 * c, 0) AS BIGINT) AS n FROM n
UNION ALL SELECT churn, 'val', CAST(round_even(0.8 * c, 0) - round_even(0.68 * c, 0) AS BIGINT) FROM n
UNION ALL SELECT churn, 'test', CAST(c - round_even(0.8 * c, 0) AS BIGINT) FROM n""")
def churn_split_counts(spark, d):
    parts = churn.stratified_split(churn.churn_features(rfm_frame(spark, d)), PARTS)
    return relational.count_by(parts, "churn", "part")


def _scored_lines(spark: SparkSession, d: str) -> DataFrame:
    return W.table(spark, d, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        (F.col("l_extendedprice") / 105000).alias("score"),
        "l_linestatus",
    )


_SCORED = """scored AS (SELECT l_linestatus, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
l_extendedprice / 105000 AS score FROM lineitem),
levels AS (SELECT l_linestatus, score, sum(label) AS pos, count(*) - sum(label) AS neg FROM scored GROUP BY ALL),
ranked AS (SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg FROM levels
  WINDOW w AS (PARTITION BY l_linestatus ORDER BY score DESC))"""


@query(f"""WITH {_SCORED} SELECT l_linestatus, round(1 - CAST(sum(pos * (cum_neg - neg / 2)) AS DOUBLE)
/ (CAST(sum(pos) AS DOUBLE) * sum(neg)), 9) AS auc FROM ranked GROUP BY l_linestatus""")
def churn_auc(spark, d):
    scored = metrics.auc_rank(_scored_lines(spark, d), by=["l_linestatus"])
    return scored.withColumn("auc", F.round("auc", 9))


@query(f"""WITH {_SCORED} SELECT l_linestatus, round(sum(pos * CAST(cum_pos AS DOUBLE) / (cum_pos + cum_neg))
/ sum(pos), 9) AS average_precision FROM ranked GROUP BY l_linestatus""")
def churn_average_precision(spark, d):
    scored = metrics.average_precision(_scored_lines(spark, d), by=["l_linestatus"])
    return scored.withColumn("average_precision", F.round("average_precision", 9))


@query(f"""WITH {_SCORED}, c AS (SELECT l_linestatus,
  count(*) FILTER (WHERE label = 1 AND score >= 0.5) AS tp, count(*) FILTER (WHERE label = 0 AND score >= 0.5) AS fp,
  count(*) FILTER (WHERE label = 1 AND score < 0.5) AS fn, count(*) FILTER (WHERE label = 0 AND score < 0.5) AS tn
  FROM scored GROUP BY l_linestatus)
SELECT *, CAST(tp AS DOUBLE) / (tp + fp) AS precision, CAST(tp AS DOUBLE) / (tp + fn) AS recall,
  CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) AS f1 FROM c""")
def churn_confusion(spark, d):
    return metrics.confusion_metrics(_scored_lines(spark, d), by=["l_linestatus"])


@query("""WITH reg AS (SELECT p_brand AS name, CAST(p_partkey AS INTEGER) AS version, p_retailprice / 1300 AS auc,
  CASE WHEN p_size = 1 THEN 'Production' ELSE 'None' END AS stage FROM part),
best AS (SELECT name, arg_max(version, (auc, -version)) AS version, max(auc) AS auc,
  max(auc) FILTER (WHERE stage = 'Production') AS incumbent_auc FROM reg GROUP BY name)
SELECT * FROM best WHERE auc >= 0.75 AND (incumbent_auc IS NULL OR auc > incumbent_auc)""")
def churn_promote(spark, d):
    registry = W.table(spark, d, "part").select(
        F.col("p_brand").alias("name"),
        F.col("p_partkey").cast("int").alias("version"),
        (F.col("p_retailprice") / 1300).alias("auc"),
        F.when(F.col("p_size") == 1, "Production").otherwise("None").alias("stage"),
    )
    return churn.promote(registry)


@query(f"""WITH reg AS (SELECT p_brand AS name, CAST(p_partkey AS INTEGER) AS version, p_retailprice / 1300 AS auc,
  p_size = 1 AS live FROM part),
best AS (SELECT name, max(auc) AS auc, max(CASE WHEN live THEN auc END) AS incumbent_auc FROM reg GROUP BY name),
won AS (SELECT b.name, min(r.version) AS version FROM best b JOIN reg r ON r.name = b.name AND r.auc = b.auc
  WHERE b.auc >= 0.75 AND (incumbent_auc IS NULL OR b.auc > incumbent_auc) GROUP BY b.name)
SELECT r.name, r.version, CASE WHEN r.version = w.version THEN 'Production'
  WHEN r.live AND w.version IS NOT NULL THEN 'Archived' WHEN r.live THEN 'Production' ELSE 'None' END AS stage
FROM reg r LEFT JOIN won w ON w.name = r.name""")
def churn_stages(spark, d):
    """The stage of every registered version after promotion."""
    registry = W.table(spark, d, "part").select(
        F.col("p_brand").alias("name"), F.col("p_partkey").cast("int").alias("version"),
        (F.col("p_retailprice") / 1300).alias("auc"),
        F.when(F.col("p_size") == 1, "Production").otherwise("None").alias("stage"),
    )
    return churn.with_stages(registry).select("name", "version", "stage")


def _stored_parts(spark: SparkSession, d: str):
    """Training parts as a stored table: every trial reads it."""
    path = run_dir(spark, "features")
    features = churn.forward_features(order_frame(spark, d), CUTOFF)
    sinks.overwrite(churn.stratified_split(features, PARTS), path, ["part"])
    stored = spark.read.parquet(path)
    return [stored.filter(F.col("part") == p).drop("part") for p in PARTS]


# Spark's own defaults: twenty trees of depth five.
_PARAMS = {"maxDepth": 5, "maxIter": 20}


@query()
def churn_scores(spark, d):
    """All customers, by a model of the training and validation rows."""
    train, val, test = _stored_parts(spark, d)
    model = churn.train_gbt(train.unionByName(val), _PARAMS)
    every = train.unionByName(val).unionByName(test)
    return churn.score(model, every).select("id_cliente", "churn", F.round("score", 6).alias("score"))


_FORWARD = f"""{O.SILVER_ORDERS}, {O.rfm('ok', CUTOFF, 180)},
f AS (SELECT id_cliente, CASE WHEN id_cliente IN (SELECT id_cliente FROM ok
  WHERE dt_transacao >= DATE '{CUTOFF}' + INTERVAL 1 DAY AND dt_transacao < DATE '{CUTOFF}' + INTERVAL 31 DAY)
  THEN 0 ELSE 1 END AS churn FROM rfm)"""


@query(f"{_FORWARD} SELECT id_cliente, churn, true AS is_probability, true AS adds_up FROM f")
def churn_attribution(spark, d):
    """Whether the score of every customer is a probability, and the Shapley values of its features explain it."""
    train, val, test = _stored_parts(spark, d)
    model, _ = churn.fit_final(train, val, test, _PARAMS)
    found = churn.attributed(model, churn.score(model, train.unionByName(val).unionByName(test)))
    total = sum((F.col("attribution")[c] for c in V.FEATURES), F.col("base"))
    margin_of_score = F.log(F.col("score") / (1 - F.col("score"))) / 2
    return found.select(
        "id_cliente", "churn", F.col("score").between(0, 1).alias("is_probability"),
        ((F.abs(total - F.col("margin")) < 1e-6) & (F.abs(total - margin_of_score) < 1e-4)).alias("adds_up"),
    )


@query("SELECT i AS trial, true AS measured FROM range(8) t(i)")
def churn_trials(spark, d):
    """Eight trials of the search that learns from its trials."""
    train, val, _ = _stored_parts(spark, d)
    log = churn.parzen_search(train, val, churn.SMALL_SPACE, trials=8)[1]
    return log.select(F.col("trial").cast("long").alias("trial"), F.col("auc").between(0, 1).alias("measured"))


@query()
def churn_importance(spark, d):
    train, val, test = _stored_parts(spark, d)
    model, _ = churn.fit_final(train, val, test, _PARAMS)
    names = [c for c in V.FEATURES if c != "segmento_enc"] + ["segmento"]
    return churn.permutation_importance(model, test, names)


@query("""SELECT 'churn_predictor' AS name, CAST(1 AS INTEGER) AS version, 'None' AS stage,
TIMESTAMP '2024-06-30 12:00:00' AS trained_at, true AS is_measured, true AS gives_scores, CAST(5 AS BIGINT) AS examples""")
def churn_registered(spark, d):
    train, val, test = _stored_parts(spark, d)
    model, measured = churn.fit_final(train, val, test, _PARAMS)
    path = run_dir(spark, "model")
    row = churn.register(spark, model, path, "churn_predictor", 1, measured.first()["auc"], AT, test)
    return row.select(
        "name", "version", "stage", F.col("trained_at").cast("timestamp_ntz").alias("trained_at"),
        F.col("auc").between(0, 1).alias("is_measured"), F.col("output_schema").contains('"score"').alias("gives_scores"),
        F.size(F.from_json("input_example", "array<map<string, string>>")).cast("long").alias("examples"),
    )


# --- retrieval ------------------------------------------------------------------------


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    return W.table(spark, d, "embeddings")


def _asked(spark: SparkSession, d: str) -> DataFrame:
    return _vectors(spark, d).filter(F.col("vec_id") % 20 == 0)


def _hits(spark: SparkSession, d: str, corpus: DataFrame | None = None) -> DataFrame:
    corpus = _vectors(spark, d) if corpus is None else corpus
    return retrieval.knn_join(_asked(spark, d), corpus, 5, qid="vec_id", cid="vec_id")


_HITS = f"WITH {O.knn(O.QUERY_VECTORS, O.ALL_VECTORS)}"
_HIT_COLUMNS = "CAST(query_id AS BIGINT) AS query_id, id, rank, round(score, 6) AS score"


def _shown(hits: DataFrame) -> DataFrame:
    return hits.withColumn("score", F.round("score", 6))


@query(f"""{_HITS} SELECT label, {_HIT_COLUMNS} FROM hits JOIN embeddings ON vec_id = id""")
def knn_per_label(spark, d):
    """Hits with their labels."""
    labels = _vectors(spark, d).select(F.col("vec_id").alias("id"), "label")
    return _shown(_hits(spark, d)).join(labels, "id")


@query(f"WITH {O.knn('SELECT vec_id AS query_id, embedding AS qv FROM embeddings', O.ALL_VECTORS)} "
       f"SELECT {_HIT_COLUMNS} FROM hits")
def knn_all_rows(spark, d):
    rows = _vectors(spark, d)
    return _shown(retrieval.knn_join(rows, rows, 5, qid="vec_id", cid="vec_id"))


@query(f"WITH {O.knn('SELECT vec_id AS query_id, embedding AS qv FROM embeddings', O.ALL_VECTORS)} "
       f"SELECT {_HIT_COLUMNS} FROM hits")
def knn_block_join(spark, d):
    """The form for a query side too large to broadcast."""
    rows = _vectors(spark, d)
    return _shown(retrieval.knn_join(rows, rows, 5, qid="vec_id", cid="vec_id", max_broadcast=0))


_FILTERED = "SELECT vec_id AS id, embedding AS cv FROM embeddings JOIN documents ON vec_id = doc_id WHERE lang = 'en'"


@query(f"WITH {O.knn(O.QUERY_VECTORS, _FILTERED)} SELECT {_HIT_COLUMNS} FROM hits")
def knn_filtered(spark, d):
    docs = W.table(spark, d, "documents").filter(F.col("lang") == "en").select("doc_id")
    corpus = _vectors(spark, d).join(docs, F.col("vec_id") == F.col("doc_id"), "left_semi")
    return _shown(_hits(spark, d, corpus))


@query(f"""{_HITS} SELECT {_HIT_COLUMNS}, source, lang, n_chars, doc_id IS NOT NULL AS found
FROM hits LEFT JOIN documents ON id = doc_id""")
def knn_metadata(spark, d):
    return retrieval.with_documents(_shown(_hits(spark, d)), W.table(spark, d, "documents"), "doc_id", ["source", "lang", "n_chars"])


@query()
def ann_all_rows(spark, d):
    rows = _vectors(spark, d)
    return _shown(retrieval.ann_join(rows, rows, 5, qid="vec_id", cid="vec_id"))


@query(f"""WITH {O.knn(O.QUERY_VECTORS, O.ALL_VECTORS)}
SELECT count(DISTINCT query_id) AS queries, count(*) AS hits, true AS enough FROM hits""")
def ann_recall(spark, d):
    """The approximate search against the exact one: its recall must reach 0.9."""
    rows, asked = _vectors(spark, d), _asked(spark, d)
    found = retrieval.ann_join(asked, rows, 5, qid="vec_id", cid="vec_id")
    measured = retrieval.recall(found, _hits(spark, d))
    return measured.select("queries", "hits", (F.col("recall") >= 0.9).alias("enough"))


def _contexts(spark: SparkSession, d: str) -> DataFrame:
    docs = W.table(spark, d, "documents")
    titled = docs.withColumn("titulo", F.when(F.col("lang") == "en", F.col("source")))
    found = retrieval.with_documents(_hits(spark, d), titled, "doc_id", ["text", "titulo", "lang"])
    return retrieval.build_context(found, title="titulo", category="lang")


_CONTEXT = f"""{_HITS}, ctx AS (SELECT CAST(query_id AS BIGINT) AS query_id,
  string_agg(coalesce(text, ''), chr(10) || chr(10) ORDER BY rank) AS context
  FROM hits LEFT JOIN documents ON id = doc_id GROUP BY query_id)"""


@query(f"{_CONTEXT} SELECT * FROM ctx")
def rag_context(spark, d):
    return _contexts(spark, d).select("query_id", "context")


@query(f"""{_HITS}, s AS (SELECT query_id, rank, lang, CASE WHEN lang = 'en' THEN source END AS titulo
  FROM hits LEFT JOIN documents ON id = doc_id)
SELECT CAST(query_id AS BIGINT) AS query_id, rank AS n,
coalesce(titulo, 'sem título') AS titulo, coalesce(lang, '') AS categoria FROM s""")
def rag_sources(spark, d):
    return _contexts(spark, d).select("query_id", F.inline("sources"))


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_GROUNDED = _sql_text(prompts.GROUNDED)


@query(f"""{_CONTEXT} SELECT query_id, replace(replace({_GROUNDED}, '{{question}}', 'Grupo ' || query_id),
'{{context}}', context) AS prompt FROM ctx""")
def rag_prompt(spark, d):
    question = F.concat(F.lit("Grupo "), F.col("query_id").cast("string"))
    return _contexts(spark, d).select(
        "query_id", prompts.render(prompts.GROUNDED, {"context": "context", "question": question}).alias("prompt")
    )


def _fitted(docs: DataFrame):
    return retrieval.embedder(256).fit(docs)


@query("SELECT doc_id, 256 AS width, true AS is_unit FROM documents")
def embed_norms(spark, d):
    """Width and length of every embedding: one, or zero for a text whose words are in all texts or that has none."""
    docs = W.table(spark, d, "documents")
    made = retrieval.embed(docs, _fitted(docs))
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    return made.select("doc_id", F.size("embedding").alias("width"), ((F.abs(norm - 1) < 1e-4) | (norm == 0)).alias("is_unit"))


@query()
def embed_documents(spark, d):
    docs = W.table(spark, d, "documents")
    return retrieval.embed(docs, _fitted(docs)).select("doc_id", "embedding")


@query()
def rag_answers(spark, d):
    """Questions, retrieval, context, prompt, and the extracted answer: the first line of the best source."""
    docs, questions = W.table(spark, d, "documents"), W.table(spark, d, "benchmark")
    model = _fitted(docs)
    hits = retrieval.knn_join(
        retrieval.embed(questions, model), retrieval.embed(docs, model), 5, qid="item_id", cid="doc_id"
    )
    found = retrieval.with_documents(hits, docs, "doc_id", ["text", "source", "lang"])
    contexts = retrieval.build_context(found, title="source", category="lang")
    asked = contexts.join(questions, F.col("query_id") == F.col("item_id")).select(
        "query_id", "sources", prompts.render(prompts.GROUNDED, {"context": "context", "question": "text"}).alias("prompt")
    )

    sources = F.split("prompt", "Documentos:\n", 2)[1]
    return asked.select("query_id", "sources", F.substring_index(sources, "\n", 1).alias("resposta"))


@query("""SELECT doc_id, 'embedded' AS change FROM documents WHERE lang = 'en' AND upper(text) <> text AND doc_id % 7 > 0
UNION ALL SELECT doc_id, 'removed' FROM documents WHERE doc_id % 7 = 0""")
def index_changes(spark, d):
    """What an index of all documents needs after the texts of one language changed and some documents went."""
    docs = W.table(spark, d, "documents").select("doc_id", "text", "lang")
    model = _fitted(docs)
    path = run_dir(spark, "index")
    empty = spark.createDataFrame([], "doc_id long, __hash long, embedding array<float>")
    sinks.overwrite(retrieval.refresh_index(docs, empty, model, "doc_id"), path)
    changed = docs.filter(F.col("doc_id") % 7 > 0).withColumn(
        "text", F.when(F.col("lang") == "en", F.upper("text")).otherwise(F.col("text")))
    delta = retrieval.index_changes(changed, spark.read.parquet(path), model, "doc_id")
    return delta.embedded.select("doc_id", F.lit("embedded").alias("change")).unionByName(
        delta.removed.select("doc_id", F.lit("removed").alias("change")))


@query()
def index_refresh(spark, d):
    """An index of all documents brought up to date after the texts of one language changed."""
    docs = W.table(spark, d, "documents").select("doc_id", "text", "lang")
    model = _fitted(docs)
    path = run_dir(spark, "index")
    empty = spark.createDataFrame([], "doc_id long, __hash long, embedding array<float>")
    sinks.overwrite(retrieval.refresh_index(docs, empty, model, "doc_id"), path)
    changed = docs.withColumn("text", F.when(F.col("lang") == "en", F.upper("text")).otherwise(F.col("text")))
    fresh = retrieval.refresh_index(changed, spark.read.parquet(path), model, "doc_id")
    return fresh.select("doc_id", F.size("embedding").alias("width"))


# --- prompts --------------------------------------------------------------------------

_TASK = "Classifique a qualidade do texto."


@query(f"SELECT doc_id, '{_TASK}' || chr(10) || chr(10) || 'Texto: \"' || text || '\"' || chr(10) || chr(10) || "
       "'Qualidade:' AS prompt FROM documents")
def prompt_zero_shot(spark, d):
    docs = W.table(spark, d, "documents")
    return prompts.zero_shot(docs, _TASK, "text", "Qualidade").select("doc_id", "prompt")


@query(f"""WITH picked AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY doc_id) AS turn FROM labels),
ex AS (SELECT turn, quality, text FROM picked JOIN documents USING (doc_id) WHERE turn <= 2 ORDER BY turn, quality LIMIT 3),
numbered AS (SELECT *, row_number() OVER (ORDER BY turn, quality) AS i FROM ex),
block AS (SELECT string_agg('[' || i || '] "' || text || '" => Qualidade: ' || quality, chr(10) ORDER BY i) AS b FROM numbered)
SELECT item_id, '{_TASK}' || chr(10) || chr(10) || b || chr(10) || '[?] "' || text || '" => Qualidade:' AS prompt
FROM benchmark, block""")
def prompt_few_shot(spark, d):
    docs = W.table(spark, d, "documents").select("doc_id", "text")
    picked = prompts.pick_examples(W.table(spark, d, "labels"), "quality", [F.asc("doc_id")], 2)
    shown = prompts.few_shot(
        W.table(spark, d, "benchmark"), picked.join(docs, "doc_id"), 3, _TASK, "text", "quality",
        ["turn", "quality"], "Qualidade",
    )
    return shown.select("item_id", "prompt")


def _filled(template: str, fields: dict[str, str]) -> str:
    text = _sql_text(template)
    for name, expression in fields.items():
        text = f"replace({text}, '{{{name}}}', {expression})"
    return text


_RFM_FIELDS = {
    **{c: f"CAST({c} AS VARCHAR)" for c in ("recency_dias", "frequency", "r_score", "f_score", "m_score", "rfm_score")},
    "id_cliente": "id_cliente",
    "monetary": "printf('%.2f', monetary)",
}


@query(f"{O.SILVER_ORDERS}, {O.rfm('ok', REF)} SELECT id_cliente, {_filled(prompts.RFM_REASONING, _RFM_FIELDS)} AS prompt FROM rfm")
def prompt_step_by_step(spark, d):
    return prompts.step_by_step(rfm_frame(spark, d)).select("id_cliente", "prompt")


_PROFILE = "{frequency} pedidos; o mais novo tem {recency_dias} dias; notas {rfm_score}."
_JSON_HEAD = _sql_text(f"Responda apenas com um objeto JSON neste formato:\n{prompts.answer_layout()}\n\nPerfil:\n")


@query(f"""{O.SILVER_ORDERS}, {O.rfm('ok', REF)} SELECT id_cliente, {_JSON_HEAD} || {_filled(_PROFILE, _RFM_FIELDS)}
|| chr(10) || chr(10) || 'JSON:' AS prompt FROM rfm""")
def prompt_json(spark, d):
    asked = prompts.json_prompt(
        rfm_frame(spark, d), _PROFILE, {c: c for c in ("recency_dias", "frequency", "rfm_score")}
    )
    return asked.select("id_cliente", "prompt")


_ROLE = "Você responde em linguagem executiva."


@query(f"""SELECT conv_id, turn, 'system' AS r0, '{_ROLE}' AS c0, 'user' AS r1, text AS c1 FROM conversations""")
def prompt_role(spark, d):
    talk = prompts.with_role(W.table(spark, d, "conversations").withColumnRenamed("role", "speaker"), _ROLE, "text")
    first, second = F.col("messages")[0], F.col("messages")[1]
    return talk.select(
        "conv_id", "turn", first["role"].alias("r0"), first["content"].alias("c0"),
        second["role"].alias("r1"), second["content"].alias("c1"),
    )


@query("""WITH a AS (SELECT c_custkey, c_custkey % 7 AS k, (c_custkey % 11) / 10.0 AS s FROM customer)
SELECT c_custkey, CASE WHEN k = 0 OR k = 3 THEN NULL WHEN k = 1 THEN 'Outro' ELSE 'Leal' END AS segmento,
  CASE WHEN k = 0 OR k = 3 THEN NULL ELSE CAST(s AS DOUBLE) + CASE WHEN k = 2 THEN 2 ELSE 0 END END AS score,
  CASE WHEN k = 0 OR k = 3 THEN NULL ELSE CAST(2 AS INTEGER) END AS acoes,
  CASE WHEN k = 0 OR k = 3 THEN 'JSON inválido' WHEN k = 1 THEN 'segmento desconhecido'
       WHEN k = 2 THEN 'score fora de 0-1' WHEN k = 4 THEN 'urgencia ausente' END AS problem FROM a""")
def prompt_parse_answers(spark, d):
    """Answers for all customers: cut off, with trailing text, with unknown and missing values, and good ones."""
    kind = F.col("c_custkey") % 7
    number = (F.col("c_custkey") % 11) / F.lit(10.0) + F.when(kind == 2, 2).otherwise(0)
    body = F.to_json(F.struct(
        F.when(kind == 1, "Outro").otherwise("Leal").alias("segmento"),
        number.alias("score_risco_churn"),
        F.array(F.lit("ligar"), F.lit("ofertar")).alias("acoes_recomendadas"),
        F.lit("SMS").alias("canal_preferencial"),
        F.when(kind != 4, "Alta").alias("urgencia"),
    ))
    text = (
        F.when(kind == 0, F.substring(body, 1, 30))
        .when(kind == 3, F.concat(body, F.lit(" obrigado")))
        .otherwise(F.concat(F.lit("  "), body, F.lit("\n")))
    )
    answers = W.table(spark, d, "customer").select("c_custkey", text.alias("resposta"))
    parsed = prompts.parse_answers(answers, "resposta")
    return parsed.select(
        "c_custkey", F.col("answer.segmento").alias("segmento"), F.col("answer.score_risco_churn").alias("score"),
        F.when(F.col("answer").isNotNull(), F.size("answer.acoes_recomendadas")).alias("acoes"), "problem",
    )


@query("SELECT item_id, length(text) AS n FROM benchmark")
def prompt_generate(spark, d):
    """Length of every prompt, by which calls to a model are sized."""
    return W.table(spark, d, "benchmark").select("item_id", F.length("text").cast("long").alias("n"))


# --- table upkeep ---------------------------------------------------------------------


def _versioned(spark: SparkSession, d: str) -> SnapshotTable:
    """Events in three versions: the first half of the month, all of it, all with amounts doubled."""
    table = SnapshotTable(spark, run_dir(spark, "events"))
    rows = events(spark, d)
    table.write(rows.filter(F.col("ts") < SPLIT), dt.datetime(2024, 2, 1))
    table.write(rows, dt.datetime(2024, 2, 2))
    table.write(rows.withColumn("value", F.col("value") * 2), dt.datetime(2024, 2, 20))
    return table


def _local_time(df: DataFrame) -> DataFrame:
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query(f"SELECT * FROM events WHERE ts < TIMESTAMP '{SPLIT}'")
def snapshot_read_version(spark, d):
    return _versioned(spark, d).read(0)


_COMMITS = f"""SELECT 0::BIGINT AS version, TIMESTAMP '2024-02-01' AS timestamp, 'WRITE' AS operation,
(SELECT count(*) FROM events WHERE ts < TIMESTAMP '{SPLIT}') AS rows
UNION ALL SELECT 1, TIMESTAMP '2024-02-02', 'WRITE', (SELECT count(*) FROM events)
UNION ALL SELECT 2, TIMESTAMP '2024-02-20', 'WRITE', (SELECT count(*) FROM events)"""


@query(f"SELECT * FROM ({_COMMITS}) ORDER BY version DESC LIMIT 2")
def snapshot_history(spark, d):
    return _local_time(_versioned(spark, d).history(2))


@query("SELECT * FROM events")
def snapshot_restore(spark, d):
    table = _versioned(spark, d)
    table.restore(dt.datetime(2024, 3, 1), timestamp=dt.datetime(2024, 2, 10))
    return table.read()


@query(f"SELECT * FROM ({_COMMITS}) WHERE version < 2")
def snapshot_expired(spark, d):
    return _local_time(_versioned(spark, d).expire(dt.datetime(2024, 3, 1)))


@query(f"SELECT * FROM ({_COMMITS}) WHERE version = 2")
def snapshot_after_expire(spark, d):
    table = _versioned(spark, d)
    table.expire(dt.datetime(2024, 3, 1), dry_run=False)
    return _local_time(table.history())


@query(f"""SELECT event_id, CASE WHEN ts < TIMESTAMP '{SPLIT}' THEN 'changed' ELSE 'added' END AS change
FROM events WHERE ts >= TIMESTAMP '{SPLIT}' OR value <> value * 2""")
def snapshot_diff(spark, d):
    """Two versions of the events: the first half of the month, and the whole with amounts doubled."""
    rows = events(spark, d)
    new = rows.withColumn("value", F.col("value") * 2)
    return relational.diff_versions(rows.filter(F.col("ts") < SPLIT), new, ["event_id"])


@query("SELECT * FROM events")
def snapshot_clone(spark, d):
    return _versioned(spark, d).clone(run_dir(spark, "clone"), AT, version=1).read()


@query("SELECT * REPLACE (value * 2 AS value) FROM events")
def snapshot_optimize(spark, d):
    table = _versioned(spark, d)
    table.optimize(AT, ["user_id", "ts"])
    return table.read()


@query("SELECT * FROM events")
def table_compact(spark, d):
    """Small files of a partitioned table merged: one partition first, then all, clustered."""
    path = run_dir(spark, "parts")
    events(spark, d).repartition(4).write.partitionBy("event_type").parquet(path)
    layout.compact(spark, path, {"event_type": "view"})
    layout.compact(spark, path, cluster_by=["user_id", "ts"])
    return spark.read.parquet(path)


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, l_extendedprice FROM lineitem")
def table_zorder(spark, d):
    rows = W.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice")
    return layout.clustered(rows, ["l_partkey", "l_shipdate"])


@query(f"WITH {O.ORDERS_RAW} SELECT * FROM raw WHERE dt_transacao >= DATE '{REF}' - INTERVAL 730 DAY")
def table_retention(spark, d):
    return relational.apply_retention(W.orders_tx(spark, d), "dt_transacao", V.RETENTION_DAYS["gold"], REF)


@query("""SELECT 'u' || user_id || '@example.org' AS usuario, ts AS event_time, 'silver.transacoes' AS tabela,
CASE event_type WHEN 'view' THEN 'selectFromTable' ELSE 'readFromTable' END AS action_name,
'10.0.0.' || event_id % 256 AS source_ip_address
FROM events WHERE event_type IN ('view', 'click') AND user_id % 2 = 0""")
def audit_pii_access(spark, d):
    return relational.pii_access(
        W.access_log(spark, d), V.READ_ACTIONS, ["silver.transacoes", "bronze.transacoes_raw"]
    )
