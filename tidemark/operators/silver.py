"""Bronze to silver: standard texts, clean ids, derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.functions import values as V
from tidemark.operators.scd import Versions

SILVER_VERSIONS = Versions("id_transacao", V.TRACKED, "dt_transacao")


def cleanse(df: DataFrame) -> DataFrame:
    """Standardised transactions with date parts, band and channel flag."""
    clean = C.standardise(df, ["produto", "canal", "status"]).withColumns({
        "id_cliente": C.clean_id("id_cliente"),
        "valor": C.money_round("valor"),
        **C.date_parts("dt_transacao"),
    })
    return clean.withColumns({
        "faixa_valor": C.band("valor", V.BAND_EDGES, V.BAND_LABELS),
        "is_digital": F.col("canal").isin(*V.DIGITAL_CHANNELS),
    })
