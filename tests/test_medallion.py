import datetime as dt
import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import churn
from tidemark.operators.quality import GateError
from tidemark.operators.relational import backfill
from tidemark.plans.medallion import Feed, Lakehouse
from tidemark.session import run_dir

AT = dt.datetime(2024, 6, 1, 8)


def write(folder, name, records):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(json.dumps(r) for r in records) + "\n")


def tx(i, customer, value, day, status="aprovado", **more):
    return {
        "id_transacao": f"t{i}", "id_cliente": f"CLI-{customer:04d}", "valor": value,
        "dt_transacao": f"{day}T10:00:00Z", "produto": " livro", "canal": "app ", "status": status, **more,
    }


def test_whole_run(spark):
    root = run_dir(spark, "lake")
    raw = root + "/raw/azure"
    days = [f"2024-0{1 + i % 5}-{1 + i % 27:02d}" for i in range(60)]
    write(raw, "1.json", [tx(i, i % 12, 50.0 + i, d) for i, d in enumerate(days)] + [{"valor": 3.0}, tx(99, 1, -5, "2024-01-01")])
    lake = Lakehouse(spark, root)
    feeds = [Feed("azure", raw, tag="azure")]
    first = lake.run(feeds, "2024-06-01", AT, full=True)
    assert (first.batches[0]["validos"], first.batches[0]["quarentena"], first.silver_batch) == (60, 2, 0)
    assert rows(first.quality, "tabela", "pct_qualidade") == [("gold.rfm_clientes", 100.0), ("silver.transacoes", 100.0)]
    assert lake.silver.current().count() == 60 and lake.rfm("2024-06-01").count() == 12
    assert lake.table("gold", "receita_diaria").agg(F.sum("receita_total")).first()[0] == sum(50.0 + i for i in range(60))

    # A second file: one changed transaction twice, one resent as it was, one new field.
    write(raw, "2.json", [
        tx(0, 0, 50.0, "2024-05-30", "cancelado", loja="centro"), tx(0, 0, 50.0, "2024-05-29", "pendente"),
        tx(1, 1, 51.0, "2024-05-31"),
    ])
    second = lake.run(feeds, "2024-06-01", AT)
    assert second.silver_batch == 1
    history = lake.silver.history().filter("id_transacao = 't0'")
    assert rows(history, "status", "is_current") == [("APROVADO", False), ("CANCELADO", True)]
    assert lake.silver.current().count() == 60
    assert "loja" in lake.silver.current().columns
    assert lake.silver.history().filter("id_transacao = 't1'").count() == 1
    assert lake.refine(["azure"]) is None
    assert lake.table("data_quality", "dq_resultados").count() == 4

    # An unknown status fails a check, and the gate stops the run.
    write(raw, "3.json", [tx(500, 1, 5.0, "2024-05-31", "estranho")])
    with pytest.raises(GateError, match="silver.transacoes"):
        lake.run(feeds, "2024-06-01", AT)
    assert lake.table("data_quality", "dq_resultados").count() == 6

    before = rows(lake.table("gold", "receita_diaria"), "id_cliente", "dt_ref", "receita_total")
    silver = rows(lake.silver.history(), "id_transacao", "dt_inicio", "dt_fim")
    report = lake.maintain()
    assert rows(lake.silver.history(), "id_transacao", "dt_inicio", "dt_fim") == silver
    lake.silver.prune()
    assert rows(lake.silver.history(), "id_transacao", "dt_inicio", "dt_fim") == silver
    assert set(report) == {"receita_diaria", "rfm_clientes", "kpis_executivos"}
    assert rows(lake.table("gold", "receita_diaria"), "id_cliente", "dt_ref", "receita_total") == before


def test_backfill_runs_once(spark):
    lake = Lakehouse(spark, run_dir(spark, "fill"))
    history = spark.createDataFrame(
        [("h1", 1.0, dt.datetime(2024, 1, 1)), ("h2", 1.0, dt.datetime(2020, 1, 1))],
        "id_transacao string, valor double, dt_transacao timestamp",
    )
    feed = Feed("gcp", "unused", tag="gcp", strict=False)
    recent = backfill(history, "dt_transacao", "2024-02-01", 90)
    assert lake.backfill(feed, recent, "warehouse") and not lake.backfill(feed, recent, "warehouse")
    assert rows(lake.bronze("gcp"), "id_transacao", "_source_file") == [("h1", "warehouse")]


def test_batches_are_refined_once_even_when_backfilled_later(spark):
    root = run_dir(spark, "order")
    lake, raw = Lakehouse(spark, root), root + "/raw"
    feed = Feed("gcp", raw, tag="gcp", strict=False)
    write(raw, "1.json", [tx(1, 1, 10.0, "2024-01-01")])
    lake.ingest(feed)
    assert lake.refine(["gcp"]) == 0 and lake.refine(["gcp"]) is None
    old = lake.bronze("gcp").drop("batch_id", "_source_file", "_ingestion_time", "_cloud_origem")
    lake.backfill(feed, old.withColumn("id_transacao", F.lit("h1")), "warehouse")
    assert lake.refine(["gcp"]) == 1
    write(raw, "2.json", [tx(2, 1, 10.0, "2024-01-02")])
    lake.ingest(feed)
    assert lake.refine(["gcp"]) == 2 and lake.refine(["gcp"]) is None
    assert rows(lake.silver.current(), "id_transacao", "_source_file")[0] == ("h1", "warehouse")
    assert rows(lake.silver.current(), "id_transacao") == [("h1",), ("t1",), ("t2",)]
    assert json.loads(lake.silver.state().progress) == {"gcp": [-1, 1]}


def test_training_step(spark):
    lake = Lakehouse(spark, run_dir(spark, "train"))
    cols = ["recency_dias", "frequency", "monetary", "r_score", "f_score", "m_score"]
    n = F.col("id")
    rfm = spark.range(200).select(
        F.concat(F.lit("C"), n.cast("string")).alias("id_cliente"), (n % 60).cast("int").alias(cols[0]),
        (n % 7 + 1).alias(cols[1]), (n * 1.5).alias(cols[2]), *[(n % 5 + 1).cast("int").alias(c) for c in cols[3:]],
        F.lit(333).alias("rfm_score"), F.when(n % 2 == 0, "Leal").otherwise("Regular").alias("segmento"),
        F.lit("2024-06-01").cast("date").alias("dt_calculo"),
    )
    rfm.write.partitionBy("dt_calculo").parquet(lake.path("gold", "rfm_clientes"))
    for version in (1, 2):
        registry = lake.train("2024-06-01", dt.datetime(2024, 6, version), churn.SMALL_SPACE, trials=2, forward_days=None)
    # The first version went into production; the second one is no better.
    assert rows(registry, "version", "stage") == [(1, "Production"), (2, "None")]
    assert churn.promote(registry).isEmpty()
    assert lake.table("ml", "trials").count() == 4
    assert lake.train("2024-06-01", dt.datetime(2024, 6, 3), churn.SMALL_SPACE, trials=2, forward_days=None, min_auc=2.0).count() == 3


def test_training_on_what_follows(spark):
    """Features end before the days the label is from."""
    root = run_dir(spark, "forward")
    lake, raw = Lakehouse(spark, root, buckets=2), root + "/raw"
    days = [dt.date(2024, 1, 5) + dt.timedelta(i % 147) for i in range(600)]
    # Customers of odd number go on buying, the others stop in May.
    write(raw, "1.json", [
        tx(i, i % 60, 20.0 + i % 13, d.isoformat()) for i, d in enumerate(days) if i % 2 or d < dt.date(2024, 4, 20)
    ])
    feed = Feed("azure", raw, tag="azure")
    lake.ingest(feed)
    lake.refine(["azure"])
    registry = lake.train("2024-05-31", dt.datetime(2024, 6, 1), churn.SMALL_SPACE, trials=2)
    features = lake.table("ml", "features")
    stopped = features.filter(F.col("id_cliente").substr(-1, 1).cast("int") % 2 == 0)
    assert stopped.count() == 30 and stopped.filter("churn = 1").count() == 30
    assert features.agg(F.min("recency_dias")).first()[0] >= 0
    assert registry.count() == 1
