import numpy as np
import pandas as pd
import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from tidemark.operators import cells as C
from tidemark.operators import retrieval as R


def vectors(spark, n, seed, copies=0):
    """Vectors of width 8; the first ``copies`` are the same vector, one is zero."""
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, 8))
    if copies:
        m[:copies] = m[0]
    if n > copies + 1:
        m[-1] = 0
    return m, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id long, embedding array<double>")


def brute(q, c, k):
    unit = lambda m: np.divide(m, np.linalg.norm(m, axis=1, keepdims=True), out=np.zeros_like(m), where=m.any(axis=1, keepdims=True))
    scores = np.round(unit(q) @ unit(c).T, 12)
    out = []
    for i, row in enumerate(scores):
        best = sorted(range(len(row)), key=lambda j: (-row[j], j))[:k]
        out += [(i, j, r) for r, j in enumerate(best, 1)]
    return sorted(out)


def pairs(hits):
    return sorted((r.query_id, r.id, r["rank"]) for r in hits.collect())


@pytest.mark.parametrize("way", ["scan", "blocks"])
def test_exact_search_against_brute_force(spark, way):
    qm, q = vectors(spark, 23, 1)
    # A third of the corpus is one vector: ties are settled by id.
    cm, c = vectors(spark, 300, 2, copies=100)
    qm[0] = cm[0]
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(qm)], "query_id long, embedding array<double>")
    extra = {} if way == "scan" else {"max_broadcast": 0, "cell_corpus": 40}
    got = R.knn_join(q, c.repartition(5), 5, **extra)
    assert pairs(got) == brute(qm, cm, 5)


def test_small_corpus_and_empty_sides(spark):
    qm, q = vectors(spark, 4, 3)
    cm, c = vectors(spark, 2, 4)
    q = q.withColumnRenamed("id", "query_id")
    assert pairs(R.knn_join(q, c, 5)) == brute(qm, cm, 5)
    assert R.knn_join(q.limit(0), c, 5).count() == 0
    assert R.knn_join(q, c.limit(0), 5).count() == 0
    assert R.knn_join(q.limit(0), c, 5, max_broadcast=-1).count() == 0


def test_all_probes_give_the_exact_result_and_few_give_most(spark):
    qm, q = vectors(spark, 20, 5)
    cm, c = vectors(spark, 400, 6, copies=130)
    q = q.filter("id < 19").withColumnRenamed("id", "query_id")
    full = R.ann_join(q, c.filter("id < 399"), 5, cells=6, probes=6, part_rows=50)
    assert pairs(full) == brute(qm[:19], cm[:399], 5)
    some = R.ann_join(q, c.filter("id < 399"), 5, cells=6, probes=3)
    near = {p[:2] for p in pairs(some)} & {p[:2] for p in brute(qm[:19], cm[:399], 5)}
    assert len(near) > 0.6 * 19 * 5


def test_no_pair_rows_and_early_limit(spark):
    _, q = vectors(spark, 4, 3)
    plan = plan_of(R.knn_join(q.withColumnRenamed("id", "query_id"), q, 2))
    assert "WindowGroupLimit" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_context_keeps_rank_order_and_default_title(spark):
    hits = spark.createDataFrame(
        [(1, 7, 2, "two", None, "x"), (1, 8, 1, "one", "T", None), (2, 9, 1, "nine", "N", "y")],
        "query_id long, id long, rank int, text string, titulo string, lang string",
    )
    got = {r.query_id: r for r in R.build_context(hits, title="titulo", category="lang", separator="|").collect()}
    assert got[1].context == "one|two" and got[2].context == "nine"
    assert [tuple(s) for s in got[1].sources] == [(1, "T", ""), (2, "sem título", "x")]


def test_index_changes_name_what_moved(spark):
    docs = spark.createDataFrame([(i, f"word{i} common text") for i in range(10)], "doc_id long, text string")
    model = R.embedder(64).fit(docs)
    index = R.refresh_index(docs, spark.createDataFrame([], "doc_id long, __hash long, embedding array<float>"), model, "doc_id")
    new = docs.filter("doc_id < 8").withColumn("text", F.when(F.col("doc_id") == 3, "new words").otherwise(F.col("text")))
    new = new.unionByName(spark.createDataFrame([(50, "more")], docs.schema))
    delta = R.index_changes(new, index, model, "doc_id")
    assert rows(delta.embedded, "doc_id") == [(3,), (50,)] and rows(delta.removed, "doc_id") == [(8,), (9,)]


def test_index_refresh_embeds_only_changes(spark):
    docs = spark.createDataFrame([(i, f"word{i} common text") for i in range(10)], "doc_id long, text string")
    model = R.embedder(64).fit(docs)
    empty = spark.createDataFrame([], "doc_id long, __hash long, embedding array<float>")
    index = R.refresh_index(docs, empty, model, "doc_id")
    marked = index.withColumn("embedding", F.array(F.lit(9.0).cast("float")))
    changed = docs.filter("doc_id < 9").withColumn("text", F.when(F.col("doc_id") == 3, "new words").otherwise(F.col("text")))
    again = R.refresh_index(changed, marked, model, "doc_id")
    assert again.count() == 9
    assert rows(again.filter(F.size("embedding") == 64), "doc_id") == [(3,)]
    assert rows(R.embed(docs, model), "doc_id", "embedding") == rows(R.embed(docs.repartition(3), model), "doc_id", "embedding")


def clustered_vectors(n, d, groups, seed, spread=0.35):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(groups, d))
    return centers[rng.integers(0, groups, n)] + spread * rng.normal(size=(n, d))


def frame(spark, m, name="id"):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], f"{name} long, embedding array<double>")


def test_cells_are_even_and_cost_their_depth():
    x = C.unit(clustered_vectors(4096, 16, 9, 1))
    tree = C.learn_tree(x, 6)
    sizes = np.bincount(tree.place(x), minlength=tree.cells)
    assert tree.cells == 64 and tree.depth == 6 and sizes.sum() == 4096
    assert sizes.min() >= 56 and sizes.max() <= 72
    # Copies of one vector cannot be split; they stay in one cell.
    same = C.learn_tree(np.concatenate([np.tile(x[:1], (2000, 1)), x[:200]]), 3)
    assert len(set(same.place(np.tile(x[:1], (50, 1))).tolist())) == 1
    assert same.place(np.zeros((1, 16))).tolist() == [same.cells]


@pytest.mark.parametrize("seed", range(4))
def test_bounds_hold_for_every_row(seed):
    x, q = C.unit(clustered_vectors(800, 6, 5, seed)), C.unit(clustered_vectors(60, 6, 5, seed + 50))
    x[5], q[3] = 0, 0
    tree = C.learn_tree(x, 4)
    cell = tree.place(x)
    angle = tree.angles(x, cell)
    radii = np.array([angle[cell == i].max() if (cell == i).any() else -1.0 for i in range(tree.cells + 1)])
    bounds = tree.bounds(q, radii)
    scores = q @ x.T
    assert all(scores[:, cell == i].max() <= bounds[:, i].min() or (scores[:, cell == i] <= bounds[:, [i]]).all()
               for i in range(tree.cells + 1) if radii[i] >= 0)


def test_far_cells_are_not_asked(spark):
    """Groups far apart: a query asks few cells, and the result is exact."""
    m = clustered_vectors(1200, 8, 12, 3, spread=0.05)
    q, c = frame(spark, m[::7], "query_id"), frame(spark, m)
    asked, found = [], R.search_cells

    def counting(a, *rest):
        asked.append(a.count())
        return found(a, *rest)

    R.search_cells = counting
    try:
        hits = R.knn_join(q, c, 4, max_broadcast=0, cell_corpus=40)
        assert pairs(hits) == brute(m[::7], m, 4)
    finally:
        R.search_cells = found
    queries, cells = len(m[::7]), 32
    assert asked[0] == queries and sum(asked) < 0.4 * queries * cells


def test_hot_vector_is_searched_in_parts(spark):
    """A third of the corpus is one vector: its cell is cut into parts, and ties are settled by id over them."""
    m = clustered_vectors(600, 8, 6, 8)
    m[100:300] = m[100]
    assert pairs(R.knn_join(frame(spark, m, "query_id"), frame(spark, m), 5, max_broadcast=0, cell_corpus=30)) == brute(m, m, 5)


def test_recall_reaches_nine_tenths(spark):
    m = clustered_vectors(6000, 32, 40, 11)
    q, c = frame(spark, m[::20], "query_id"), frame(spark, m)
    exact = R.knn_join(q, c, 10)
    got = R.recall(R.ann_join(q, c, 10), exact).first()
    assert got["queries"] == 300 and got["hits"] == 3000 and got["recall"] >= 0.9


def test_codes_are_close():
    x = C.unit(clustered_vectors(300, 24, 4, 2))
    tree = C.learn_tree(x, 3)
    cell = pd.Series(tree.place(x))
    codes = R._encode(pd.Series(list(x)), cell, tree.centers)
    back = np.stack([R._decode([c], tree.centers[i])[0] for c, i in zip(codes, cell, strict=True)])
    assert len(codes[0]) == 4 + 24 and np.abs(back - x).max() < 0.01


def test_hits_without_a_document_stay(spark):
    hits = spark.createDataFrame([(1, 7, 1), (1, 99, 2), (1, 8, 3)], "query_id long, id long, rank int")
    docs = spark.createDataFrame([(7, "seven"), (8, "eight")], "doc_id long, text string")
    got = R.with_documents(hits, docs, "doc_id", ["text"])
    assert rows(got, "rank", "text", "found") == [(1, "seven", True), (2, None, False), (3, "eight", True)]
    context = R.build_context(got, separator="|").first()
    assert context.context == "seven||eight" and [s.n for s in context.sources] == [1, 2, 3]


def test_neighbouring_cells_share_bins():
    assert C.bin_cells([30, 30, 30, 0, 250, 40, 70], [1, 1, 1, 0, 3, 1, 1], 100).tolist() == [0, 0, 0, 0, 1, 4, 5]


def test_a_query_goes_to_a_bin_once_and_few_hits_leave_it(spark):
    """What is shuffled does not grow with cells asked: one question per bin, ``k`` hits back."""
    m = clustered_vectors(3000, 16, 9, 21)
    q, c = frame(spark, m, "query_id"), frame(spark, m)
    seen, found = [], R.search_bins

    def counting(asked, *rest):
        hits = found(asked, *rest)
        seen.append((asked.count(), asked.select(F.sum(F.size("cells"))).first()[0], hits.count()))
        return hits

    R.search_bins = counting
    try:
        got = R.ann_join(q, c, 3, cell_rows=16)
        assert R.recall(got, R.knn_join(q, c, 3)).first()["recall"] >= 0.9
    finally:
        R.search_bins = found
    asked, cells, hits = seen[0]
    assert asked <= 2 * C.MIN_BINS * len(m) < cells / 2 and hits <= 3 * asked


def test_ties_of_many_copies_take_no_more_than_k_places():
    scores = np.tile([0.5, 1.0, 0.5, 0.5, 0.1], (3, 1))
    assert C.best(scores, 3).tolist() == [[True, True, True, False, False]] * 3
    assert C.best(scores, 3, np.array([4, 3, 2, 1, 0])).tolist() == [[False, True, True, True, False]] * 3


def test_questions_leave_in_small_strips():
    """A batch of queries that all ask every cell is not copied out at once."""
    assert max(at.stop - at.start for at in C.strips(10_000, 40)) * 40 <= 20_000
