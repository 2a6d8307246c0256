"""Fixed domain values: they must equal the published table contracts."""

from pyspark.sql import types as T

# Raw transaction schema.
RAW_SCHEMA = (
    "id_transacao string, id_cliente string, valor double, dt_transacao timestamp, "
    "produto string, canal string, status string"
)

# Silver contract, in declared order.
SILVER_SCHEMA = (
    "id_transacao string not null, id_cliente string, valor double, dt_transacao timestamp, "
    "produto string, canal string, status string, faixa_valor string, is_digital boolean, "
    "ano_transacao int, mes_transacao int, dia_transacao int, hora_transacao int, "
    "dt_inicio timestamp, dt_fim timestamp, is_current boolean, "
    "_source_file string, _ingestion_time timestamp, _cloud_origem string"
)

# RFM contract, in declared order.
RFM_SCHEMA = (
    "id_cliente string not null, recency_dias int, frequency bigint, monetary double, "
    "r_score int, f_score int, m_score int, rfm_score int, segmento string, dt_calculo date"
)

# Shape of a structured model answer.
ANSWER_SCHEMA = T.StructType([
    T.StructField("segmento", T.StringType()),
    T.StructField("score_risco_churn", T.DoubleType()),
    T.StructField("acoes_recomendadas", T.ArrayType(T.StringType())),
    T.StructField("canal_preferencial", T.StringType()),
    T.StructField("urgencia", T.StringType()),
])

# Amount bands: upper edges (exclusive) and labels.
BAND_EDGES = [100, 1000, 10000]
BAND_LABELS = ["baixo", "medio", "alto", "premium"]

# Value sets.
STATUSES = ["APROVADO", "REPROVADO", "CONCLUIDO", "CANCELADO", "PENDENTE"]
VALID_STATUSES = ["APROVADO", "CONCLUIDO"]
CHANNELS = ["APP", "WEB", "API", "LOJA", "TELEFONE", "PARCEIRO"]
DIGITAL_CHANNELS = ["APP", "WEB", "API"]
SEGMENTS = ["Campeao", "Leal", "Regular", "Em_Risco", "Inativo", "Novo"]
CONTACT_CHANNELS = ["Email", "SMS", "Push", "Telefonema"]
URGENCIES = ["Alta", "Media", "Baixa"]

# Quarantine reasons.
REASON_NULL_ID = "id_transacao nulo"
REASON_NULL_AMOUNT = "valor nulo"
REASON_NEGATIVE = "valor negativo"

# Attributes whose change opens a new version of a transaction.
TRACKED = ["status", "faixa_valor", "canal", "produto"]

# Model inputs, in order.
FEATURES = [
    "recency_dias",
    "frequency",
    "monetary",
    "r_score",
    "f_score",
    "m_score",
    "rfm_score",
    "segmento_enc",
]

# Days each layer keeps its rows.
RETENTION_DAYS = {
    "bronze": 90,
    "silver": 365,
    "gold": 730,
    "ml": 365,
    "genai": 365,
    "data_quality": 180,
}

# Audit actions that count as a read of personal data.
READ_ACTIONS = ["selectFromTable", "readFromTable"]

# Default title of a document without one.
NO_TITLE = "sem título"

# Bounds of the least gain of a split. Spark averages the gain over the rows of a node, so useful bounds are far
# below those for summed losses.
MIN_GAIN = (0.0, 0.05)
