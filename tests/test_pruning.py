"""What the history opens: folders named by the keys of a batch, open rows, and months."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
from conftest import rows
from pyspark.sql import functions as F
from test_scd import DDL, V, at, brute, same

from tidemark.operators import gold
from tidemark.plans.medallion import Feed, Lakehouse, months_before
from tidemark.session import run_dir
from tidemark.sources.versions import VersionStore


def scanned(df):
    """Files and rows that the scans of a plan read, by Spark's own metrics."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = df.select("*")
        df._jdf.queryExecution().executedPlan().executeCollect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        found = [leaves.apply(i).metrics() for i in range(leaves.size())]
        count = lambda m, name: m.apply(name).value() if m.contains(name) else 0
        return sum(count(m, "numFiles") for m in found), sum(count(m, "numOutputRows") for m in found)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def filled(spark, buckets=16, keys=400):
    """Three batches: two thirds of the keys change in the second, one key in the third."""
    store = VersionStore(spark, run_dir(spark, "pruned"), V, buckets)
    first = [(f"k{i}", "x", "p", at(i % 48), i) for i in range(keys)]
    second = [(f"k{i}", "y", "p", at(800 + i % 48), keys + i) for i in range(keys) if i % 3]
    store.apply(spark.createDataFrame(first, DDL))
    store.apply(spark.createDataFrame(second, DDL))
    return store, first + second


def test_a_batch_of_one_key_opens_one_bucket(spark):
    store, data = filled(spark)
    one = spark.createDataFrame([("k7",)], "k string")
    state = store.state()
    bucket = one.select(store._bucket(state).alias("b")).first()["b"]
    files, read = scanned(store._open(one, state))
    all_files, all_read = scanned(store.current())
    # One file a batch and month of the open rows, one a batch of the ends, and the key itself.
    assert files <= 4 and files * 4 < all_files and read * 6 < all_read
    opened = store._committed("versions", state, [bucket], open_only=True).select(F.input_file_name().alias("f"))
    assert all(f"__open=true/__bucket={bucket}/" in r["f"] for r in opened.distinct().collect())
    assert rows(store._open(one, state), "k", "a") == [("k7", "y")]
    store.apply(spark.createDataFrame([("k7", "z", "p", at(2000), 5000)], DDL))
    same(store.history(), brute([*data, ("k7", "z", "p", at(2000), 5000)]))


def test_current_rows_do_not_open_closed_ones(spark):
    store, data = filled(spark)
    store.fold()
    want = [r for r in brute(data) if r[-1]]
    assert scanned(store.current())[1] == len(want)
    same(store.current(), want)
    same(store.history(), brute(data))
    # A month opens its own folders only.
    month = "2024-02"
    of_month = [r for r in want if r[3].strftime("%Y-%m") == month]
    assert 0 < len(of_month) < len(want)
    assert scanned(store.current([month]))[1] == len(of_month)
    same(store.current([month]), of_month)


def test_the_number_of_buckets_stays(spark):
    store, data = filled(spark, buckets=4)
    again = VersionStore(spark, store.path, V, buckets=99)
    again.apply(spark.createDataFrame([("k1", "z", "p", at(3000), 7000)], DDL))
    assert again.state().buckets == 4
    same(again.history(), brute([*data, ("k1", "z", "p", at(3000), 7000)]))


def test_months():
    assert months_before("2024-03-01", 0) == ["2024-03"]
    assert months_before("2024-03-01", 365) == [f"2023-{m:02d}" for m in range(3, 13)] + ["2024-01", "2024-02", "2024-03"]
    assert dt.date(2024, 3, 1) - dt.timedelta(365) == dt.date(2023, 3, 2)


def orders(spark, rows_):
    return spark.createDataFrame(
        [(f"t{i}", f"C{c:04d}", float(v), dt.datetime.fromisoformat(day), "livro", "app", status) for i, c, v, day, status in rows_],
        "id_transacao string, id_cliente string, valor double, dt_transacao timestamp, produto string, canal string, status string",
    )


def test_monthly_totals_follow_their_batches(spark):
    """Totals renewed month by month equal those of all current rows; other months are not written again."""
    root = run_dir(spark, "months")
    lake, feed = Lakehouse(spark, root, buckets=4), Feed("f", f"{root}/raw", tag="azure")

    def load(rows_):
        orders(spark, rows_).write.mode("append").json(f"{root}/raw")
        lake.ingest(feed)
        lake.refine(["f"])
        return lake.monthly_totals()

    def check(found):
        whole = gold.monthly_totals(gold.approved(lake.silver.current()))
        assert rows(found.select(*whole.columns)) == rows(whole)

    days = [f"2024-0{m}-1{m}" for m in range(1, 7)]
    check(load([(i, i % 5, 10 + i, days[i % 6], "aprovado") for i in range(60)]))
    files = lambda: {r["f"] for r in lake.table("gold", "totais_mensais").select(F.col("_metadata.file_path").alias("f")).distinct().collect()}
    before = files()
    # One sale moves from January to March, April loses all its sales, one is new in July.
    moved = [(0, 0, 99, "2024-03-20", "concluido"), (200, 9, 5, "2024-07-01", "concluido")]
    check(load(moved + [(i, i % 5, 10 + i, "2024-06-30", "cancelado") for i in range(3, 60, 6)]))
    assert lake.silver.touched_months(0) == ["2024-01", "2024-03", "2024-04", "2024-06", "2024-07"]
    kept = {f for f in before if "mes_transacao=2/" in f or "mes_transacao=5/" in f}
    assert len(kept) == 2 and kept <= files() and len(files() & before) == 2
    assert not any("mes_transacao=4/" in f for f in files())
    # Nothing new: nothing is written; a fold changes no month.
    before = files()
    lake.silver.fold()
    check(lake.monthly_totals())
    assert files() == before
    check(load([(300, 1, 7, "2024-05-02", "aprovado")]))
    check(lake.monthly_totals(full=True))


def test_footers_of_new_files_only(spark, tmp_path):
    lake, folder = Lakehouse(spark, run_dir(spark, "footers")), tmp_path / "raw"
    folder.mkdir()
    feed = Feed("p", str(folder), "parquet", strict=False)

    def drop(name, i, **more):
        row = {
            "id_transacao": f"t{i}", "id_cliente": "C0001", "valor": 5.0, "dt_transacao": dt.datetime(2024, 1, i),
            "produto": "livro", "canal": "app", "status": "aprovado", **more,
        }
        pq.write_table(pa.table({k: pa.array([v], pa.timestamp("us", "UTC") if k == "dt_transacao" else None) for k, v in row.items()}), folder / name)

    drop("1.parquet", 1)
    assert [b["validos"] for b in lake.ingest(feed)] == [1]
    # The file is still listed, but whoever opens it again fails.
    (folder / "1.parquet").write_bytes(b"no parquet")
    os.utime(folder / "1.parquet", (1_600_000_000, 1_600_000_000))
    drop("2.parquet", 2, loja="centro")
    assert [b["validos"] for b in lake.ingest(feed)] == [1]
    assert rows(lake.bronze("p"), "id_transacao", "loja") == [("t1", None), ("t2", "centro")]
