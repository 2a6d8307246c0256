import datetime as dt

from conftest import plan_of, rows
from pyspark.sql import functions as F

from tidemark.operators import retrieval
from tidemark.operators.scd import Versions
from tidemark.operators.sizes import measured_bytes, small
from tidemark.session import run_dir
from tidemark.sources.versions import VersionStore


def test_hint_follows_the_size(spark):
    big = spark.range(100).withColumn("t", F.repeat(F.lit("x"), 50))
    assert measured_bytes(big) == 100 * (32 + 16 + 50)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        other = spark.range(1000)
        assert "BroadcastHashJoin" in plan_of(other.join(small(big), "id"))
        assert "SortMergeJoin" in plan_of(other.join(small(big, limit=1000), "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert measured_bytes(big.limit(0)) == 0


def test_a_small_batch_does_not_shuffle_the_history(spark):
    v = Versions("k", ["a"], "ts")
    store = VersionStore(spark, run_dir(spark, "sizes"), v)
    at = dt.datetime(2024, 1, 1)
    store.apply(spark.range(500).select(F.col("id").alias("k"), F.lit("x").alias("a"), F.lit(at).alias("ts")))
    store.apply(spark.range(9).select(F.col("id").alias("k"), F.lit("y").alias("a"), F.lit(at + dt.timedelta(1)).alias("ts")))
    touched = store._open(spark.range(3).select(F.col("id").alias("k")))
    assert "SortMergeJoin" not in plan_of(touched)
    assert rows(touched, "k", "a") == [(0, "y"), (1, "y"), (2, "y")]
    assert "SortMergeJoin" not in plan_of(store.current())
    assert store.current().count() == 500 and store.history().count() == 509


def test_texts_of_hits_are_not_shuffled(spark):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.repeat(F.lit("t"), 100).alias("text"))
    hits = spark.createDataFrame([(1, 7, 1, 0.5)], "query_id long, id long, rank int, score double")
    plan = plan_of(retrieval.with_documents(hits, docs, "doc_id", ["text"]))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_one_large_cell_is_not_gathered(spark):
    vectors = spark.range(500).select("id", F.array(*[F.col("id") * i + 1.0 for i in range(4)]).alias("embedding"))
    queries = vectors.withColumnRenamed("id", "query_id")
    plan = plan_of(retrieval.knn_join(queries, vectors, 3, max_broadcast=0, cell_corpus=100))
    keyed = [line for line in plan.splitlines() if "Exchange hashpartitioning(cell#" in line]
    # Rows move by cell and part; the corpus side is not joined, so it is not copied.
    assert keyed and all("part#" in line for line in keyed)
    assert "Generate" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
