"""DuckDB statements that state the expected result of the registered queries."""

from __future__ import annotations

ORDER_COLUMNS = """
  'C-' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS id_cliente,
  o_orderdate AS dt_transacao,
  CASE o_orderpriority WHEN '1-URGENT' THEN ' app' WHEN '2-HIGH' THEN 'Web ' WHEN '3-MEDIUM' THEN 'api'
    WHEN '4-NOT SPECIFIED' THEN 'loja' WHEN '5-LOW' THEN ' telefone ' ELSE o_orderpriority END AS canal,
  CASE o_orderstatus WHEN 'F' THEN 'aprovado ' WHEN 'O' THEN 'Concluido' WHEN 'P' THEN ' pendente'
    ELSE o_orderstatus END AS status
"""

LINES = """
lines AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
               l_returnflag, l_linestatus) AS rn
    FROM lineitem) WHERE rn = 1
)"""


def raw(lines: str) -> str:
    return f"""
raw AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id_transacao,
         l_extendedprice AS valor, lower(p_type) AS produto, {ORDER_COLUMNS}, l_shipdate AS _ingestion_time
  FROM {lines} JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
)"""


ORDERS_RAW = f"""
raw AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id_transacao, o_totalprice AS valor, 'pedido' AS produto, {ORDER_COLUMNS}
  FROM orders
)"""

CLEAN = """
clean AS (
  SELECT * REPLACE (
    upper(trim(produto)) AS produto, upper(trim(canal)) AS canal, upper(trim(status)) AS status,
    regexp_replace(id_cliente, '[^A-Za-z0-9]', '', 'g') AS id_cliente, round(valor, 2) AS valor)
  FROM raw
),
silver AS (
  SELECT *,
    CAST(year(dt_transacao) AS INTEGER) AS ano_transacao, CAST(month(dt_transacao) AS INTEGER) AS mes_transacao,
    CAST(day(dt_transacao) AS INTEGER) AS dia_transacao, CAST(hour(dt_transacao) AS INTEGER) AS hora_transacao,
    CASE WHEN valor < 100 THEN 'baixo' WHEN valor < 1000 THEN 'medio' WHEN valor < 10000 THEN 'alto'
      ELSE 'premium' END AS faixa_valor,
    canal IN ('APP', 'WEB', 'API') AS is_digital
  FROM clean
),
ok AS (SELECT * FROM silver WHERE status IN ('APROVADO', 'CONCLUIDO'))"""

SILVER_TX = f"WITH {LINES}, {raw('lines')}, {CLEAN}"
SILVER_ORDERS = f"WITH {ORDERS_RAW}, {CLEAN}"

CENTS = "sum(CAST(round(valor * 100) AS BIGINT))"
TOTAL = f"CAST({CENTS} AS DOUBLE) / 100"
MEAN = f"CAST((2 * {CENTS} + count(valor)) // (2 * count(valor)) AS DOUBLE) / 100"


def rfm(source: str, ref: str, days: int = 365) -> str:
    return f"""
base AS (
  SELECT id_cliente,
    CAST(date_diff('day', CAST(max(dt_transacao) AS DATE), DATE '{ref}') AS INTEGER) AS recency_dias,
    count(id_transacao) AS frequency, {TOTAL} AS monetary
  FROM {source}
  WHERE dt_transacao >= DATE '{ref}' - INTERVAL {days} DAY AND dt_transacao < DATE '{ref}' + INTERVAL 1 DAY
  GROUP BY id_cliente
),
scored AS (
  SELECT *,
    CAST(ntile(5) OVER (ORDER BY recency_dias DESC, id_cliente) AS INTEGER) AS r_score,
    CAST(ntile(5) OVER (ORDER BY frequency, id_cliente) AS INTEGER) AS f_score,
    CAST(ntile(5) OVER (ORDER BY monetary, id_cliente) AS INTEGER) AS m_score
  FROM base
),
totals AS (SELECT *, CAST(r_score * 100 + f_score * 10 + m_score AS INTEGER) AS rfm_score FROM scored),
rfm AS (
  SELECT *,
    CASE WHEN rfm_score >= 444 THEN 'Campeao' WHEN rfm_score >= 333 THEN 'Leal'
      WHEN r_score >= 4 AND f_score <= 2 THEN 'Novo' WHEN r_score <= 2 AND f_score >= 4 THEN 'Em_Risco'
      WHEN r_score <= 2 THEN 'Inativo' ELSE 'Regular' END AS segmento,
    DATE '{ref}' AS dt_calculo
  FROM totals
)"""


KPIS = f"""
months AS (
  SELECT ano_transacao, mes_transacao, {TOTAL} AS receita_mes, count(id_transacao) AS volume_mes,
    {MEAN} AS ticket_medio_mes, count(DISTINCT id_cliente) AS clientes_ativos,
    ano_transacao * 12 + mes_transacao AS m
  FROM ok GROUP BY ano_transacao, mes_transacao
),
kpis AS (
  SELECT a.ano_transacao, a.mes_transacao, a.receita_mes, a.volume_mes, a.ticket_medio_mes, a.clientes_ativos,
    b.receita_mes AS receita_mes_anterior, c.receita_mes AS receita_mesmo_mes_ano_anterior,
    round((a.receita_mes - b.receita_mes) / nullif(b.receita_mes, 0) * 100, 2) AS mom_receita_pct,
    round((a.receita_mes - c.receita_mes) / nullif(c.receita_mes, 0) * 100, 2) AS yoy_receita_pct,
    DATE '2001-08-01' AS dt_calculo
  FROM months a LEFT JOIN months b ON b.m = a.m - 1 LEFT JOIN months c ON c.m = a.m - 12
)"""

DIRTY = """
dirty AS (
  SELECT CASE WHEN event_id % 97 <> 0 THEN CAST(event_id AS VARCHAR) END AS id_transacao,
    'U-' || CAST(user_id AS VARCHAR) AS id_cliente,
    CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 83 = 0 THEN -value ELSE value END AS valor,
    ts AS dt_transacao, event_type AS produto
  FROM events
),
judged AS (
  SELECT *, CASE WHEN id_transacao IS NULL THEN 'id_transacao nulo' WHEN valor IS NULL THEN 'valor nulo'
    WHEN valor < 0 THEN 'valor negativo' END AS _motivo_quarentena
  FROM dirty
)"""


def history(source: str) -> str:
    return f"""
marked AS (
  SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM {source}
),
hist AS (
  SELECT * EXCLUDE (prev), ts AS dt_inicio,
    lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS dt_fim
  FROM marked WHERE prev IS DISTINCT FROM event_type
),
versions AS (SELECT *, dt_fim IS NULL AS is_current FROM hist)"""


def checks(rows: list[tuple[str, str, str, str]], source: str) -> str:
    """One statement per check: (name, column, condition of evaluated rows, failing condition)."""
    parts = []
    for i, (name, column, seen, fails) in enumerate(rows, 1):
        if name == "unique":
            body = (
                f"(SELECT CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS failing, "
                f"CAST(coalesce(sum(n), 0) AS BIGINT) AS evaluated FROM "
                f"(SELECT {column}, count(*) AS n FROM {source} WHERE {column} IS NOT NULL GROUP BY {column}))"
            )
        else:
            body = (
                f"(SELECT count(*) FILTER (WHERE ({seen}) AND ({fails})) AS failing, "
                f"count(*) FILTER (WHERE {seen}) AS evaluated FROM {source})"
            )
        parts.append(
            f"SELECT {i} AS position, '{name}' AS \"check\", '{column}' AS \"column\", failing, evaluated, "
            f"failing = 0 AS ok FROM {body}"
        )
    return " UNION ALL ".join(parts)


def _null(c: str) -> tuple[str, str, str, str]:
    return ("not_null", c, "true", f"{c} IS NULL")


def _value(name: str, c: str, fails: str) -> tuple[str, str, str, str]:
    return (name, c, f"{c} IS NOT NULL", fails)


SILVER_CHECKS = [
    *[_null(c) for c in ("id_transacao", "id_cliente", "valor", "dt_transacao", "is_current")],
    ("unique", "id_transacao", "", ""),
    _value("between", "valor", "valor < 0.01 OR valor > 1000000"),
    _value("in_set", "status", "status NOT IN ('APROVADO', 'REPROVADO', 'CONCLUIDO', 'CANCELADO', 'PENDENTE')"),
    _value("in_set", "canal", "canal NOT IN ('APP', 'WEB', 'API', 'LOJA', 'TELEFONE', 'PARCEIRO')"),
    _null("faixa_valor"),
    _value("in_set", "faixa_valor", "faixa_valor NOT IN ('baixo', 'medio', 'alto', 'premium')"),
    _value("length_between", "id_cliente", "length(id_cliente) < 5 OR length(id_cliente) > 50"),
    _value("between", "dt_transacao",
           "CAST(dt_transacao AS DATE) < DATE '2020-01-01' OR CAST(dt_transacao AS DATE) > DATE '2024-06-30'"),
]

RFM_CHECKS = [
    *[_null(c) for c in ("id_cliente", "segmento", "rfm_score")],
    *[_value("between", c, f"{c} < 1 OR {c} > 5") for c in ("r_score", "f_score", "m_score")],
    _value("between", "rfm_score", "rfm_score < 111 OR rfm_score > 555"),
    _value("in_set", "segmento", "segmento NOT IN ('Campeao', 'Leal', 'Regular', 'Em_Risco', 'Inativo', 'Novo')"),
    _value("between", "recency_dias", "recency_dias < 0 OR recency_dias > 3650"),
    _value("between", "monetary", "monetary < 0"),
    _value("between", "frequency", "frequency < 1"),
]


def summary(table: str, at: str, threshold: float) -> str:
    pct = "count(*) FILTER (WHERE ok) * 100.0 / count(*)"
    failures = (
        "'[' || coalesce(string_agg('{\"expectation\":\"' || \"check\" || '\",\"coluna\":\"' || \"column\" || "
        "'\",\"sucesso\":false}', ',' ORDER BY position) FILTER (WHERE NOT ok), '') || ']'"
    )
    return (
        f"SELECT '{table}' AS tabela, TIMESTAMP '{at}' AS dt_execucao, count(*) AS total_checks, "
        f"count(*) FILTER (WHERE ok) AS checks_ok, count(*) FILTER (WHERE NOT ok) AS checks_falha, "
        f"round(CAST({pct} AS DOUBLE), 2) AS pct_qualidade, {pct} >= {threshold} AS passou_threshold, "
        f"{failures} AS falhas_json"
    )


def knn(queries: str, corpus: str, k: int = 5) -> str:
    """``queries`` gives (query_id, qv), ``corpus`` gives (id, cv)."""
    return f"""
q AS ({queries}),
c AS ({corpus}),
pairs AS (
  SELECT query_id, id,
    round(list_cosine_similarity(CAST(qv AS DOUBLE[]), CAST(cv AS DOUBLE[])), 12) AS score FROM q, c
),
hits AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM pairs)
  WHERE rank <= {k}
)"""


ALL_VECTORS = "SELECT vec_id AS id, embedding AS cv FROM embeddings"
# Searches ask with every row whose id is divisible by 20.
QUERY_VECTORS = "SELECT vec_id AS query_id, embedding AS qv FROM embeddings WHERE vec_id % 20 = 0"
