import datetime as dt

from conftest import plan_of, rows

from tidemark.operators import gold
from tidemark.operators.silver import cleanse
from tidemark.plans import queries as Q
from tidemark.sources import views as W


def months(spark, data):
    recs = [(f"t{i}", f"c{i}", v, y, m) for i, (y, m, v) in enumerate(data)]
    return spark.createDataFrame(recs, "id_transacao string, id_cliente string, valor double, ano_transacao int, mes_transacao int")


def test_months_are_calendar_months(spark):
    df = months(spark, [(2023, 1, 0.0), (2023, 2, 10.0), (2023, 4, 20.0), (2024, 2, 15.0), (2024, 1, 5.0)])
    got = {(r.ano_transacao, r.mes_transacao): r for r in gold.monthly_kpis(df, "2024-03-01").collect()}
    assert len(got) == 5
    assert got[2023, 2].receita_mes_anterior == 0.0 and got[2023, 2].mom_receita_pct is None
    assert got[2023, 4].receita_mes_anterior is None
    assert got[2024, 2].receita_mesmo_mes_ano_anterior == 10.0 and got[2024, 2].yoy_receita_pct == 50.0
    assert got[2024, 2].mom_receita_pct == 200.0


def test_sums_do_not_drift(spark):
    df = months(spark, [(2024, 1, 0.1)] * 10 + [(2024, 1, 0.2)])
    row = gold.monthly_totals(df).first()
    assert (row.receita_mes, row.volume_mes, row.ticket_medio_mes, row.clientes_ativos) == (1.2, 11, 0.11, 11)


def test_few_customers_and_future_rows(spark):
    recs = [
        ("t1", "a", 1.0, dt.datetime(2024, 5, 31, 23)), ("t2", "b", 2.0, dt.datetime(2024, 6, 1, 9)),
        ("t3", "b", 3.0, dt.datetime(2024, 6, 2)), ("t4", "c", 9.0, dt.datetime(2023, 1, 1)),
    ]
    df = spark.createDataFrame(recs, "id_transacao string, id_cliente string, valor double, dt_transacao timestamp_ntz")
    got = {r.id_cliente: r for r in gold.rfm(df, "2024-06-01").collect()}
    assert set(got) == {"a", "b"}
    assert (got["a"].recency_dias, got["b"].recency_dias, got["b"].frequency, got["b"].monetary) == (1, 0, 1, 2.0)
    assert (got["a"].r_score, got["b"].r_score) == (1, 2)
    assert gold.rfm(df.limit(0), "2024-06-01").count() == 0


def test_rfm_has_no_single_partition_step(spark, small):
    result = Q.rfm_frame(spark, small)
    assert "SinglePartition" not in plan_of(result) and "Exchange" not in plan_of(result)
    assert "SinglePartition" not in plan_of(gold.monthly_kpis(Q.order_frame(spark, small), "2001-08-01"))


def test_revenue_reads_only_what_it_needs(spark, small):
    plan = plan_of(gold.daily_revenue(gold.approved(cleanse(W.transactions(spark, small)))))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 3
    assert not any("l_tax" in s or "p_name" in s or "o_totalprice" in s for s in scans)


def test_revenue_keys(spark, small):
    df = Q.gold_daily_revenue(spark, small)
    keys = ["id_cliente", "produto", "dt_ref", "canal"]
    assert df.groupBy(*keys).count().filter("count > 1").isEmpty()
    assert rows(gold.latest_months(gold.monthly_kpis(Q.order_frame(spark, small), "2001-08-01"), 2), "ano_transacao")
