import hashlib
import re

from pyspark.sql import functions as F
from tidemark.llm import sketches

ROWS = [
    (5, "one\ntwo\nthree\nfour"), (1, "a" * 700 + "\nb\nc"), (9, ""), (12, None), (3, "ééé\n中文 text\n" * 3),
    (20, "\n".join(f"line {i}" for i in range(400))), (21, "\n".join(f"line {i}" for i in range(400)) + "\nmore"), (30, "x"),
    (40, "\n".join(f"other {i}" for i in range(90))), (41, "one\ntwo\nthree\nfour"),
]


def edited(text, following):
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def units(text):
    return set(re.findall("[^\n]{1,256}", text))


def like(a, b):
    a, b = units(a), units(b)
    d = len(a ^ b)
    return 1.0 if not a and not b else (len(a) + len(b) - d) / (len(a) + len(b) + d)


def expected(rows):
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for i, (d, t) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        e = edited(t, nxt)
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), like(t, e), like(t, nxt)))
    return out


def test_equals_brute_force(spark):
    """Every difference is recovered, small or of all paragraphs; ties and missing ids have their places."""
    rows = [*ROWS, (None, "no id here\nb"), (5, "one\nother"), (5, "one\nother")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, place string").repartition(3)
    got = sketches.fingerprints(df).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in got), key=str) == sorted(expected(rows), key=str)
    prints = {r["doc_id"]: r["fingerprint"] for r in got}
    assert prints[41] != prints[1]
    assert len({len(p) for p in prints.values()}) == 1


def test_equal_texts_have_equal_fingerprints(spark):
    df = spark.createDataFrame([(1, "p\nq"), (2, "r"), (3, "p\nq")], "doc_id long, text string")
    got = {r["doc_id"]: r["fingerprint"] for r in sketches.fingerprints(df).collect()}
    assert got[1] == got[3] != got[2]


def test_one_row_and_none(spark):
    df = spark.createDataFrame([(1, "p\nq")], "doc_id long, text string")
    row = sketches.fingerprints(df).first()
    assert row["near_next"] == 1.0
    assert sketches.fingerprints(df.where("false")).count() == 0


def test_ranges(spark):
    edges = [-5, 0, 7, 8, 100]
    df = spark.range(-20, 120).select("id", sketches.range_bucket(F.col("id"), edges).alias("g"))
    for r in df.collect():
        assert r["g"] == max(sum(e <= r["id"] for e in edges) - 1, 0)


def test_recovered_digests_are_the_difference(spark):
    df = spark.createDataFrame([(1, "\n".join(f"l{i}" for i in range(60))), (2, "\n".join(f"l{i}" for i in range(30, 90)))], "doc_id long, text string")
    row = sketches.fingerprints(df).where("doc_id = 1").first()
    names = [f"l{i}" for i in (*range(30), *range(60, 90))]
    digests = {r["d"] for r in spark.createDataFrame([(n,) for n in names], "t string").select(F.xxhash64("t").alias("d")).collect()}
    assert {x["found"] for x in row["differs_next"]} == digests
    assert sum(x["n"] for x in row["differs_next"]) == 0


def test_whole_table(spark, small):
    from tidemark.llm.queries import QUERIES

    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op10_fingerprints"](spark, small).collect()
    assert sorted((r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in got) == sorted(expected(rows))


def test_fingerprints_alone_settle_small_differences(spark):
    """What is peeled inside the row is the whole difference with its signs, as the rounds over cells find it."""
    texts = [range(30), range(32), range(1, 33), range(28, 60), range(28, 60), range(27, 59), [], [3], range(100, 106)]
    texts += [range(i, i + 5 + i % 9) for i in range(200, 600, 3)]
    df = spark.createDataFrame([(i, "\n".join(f"l{x}" for x in t)) for i, t in enumerate(texts)], "doc_id long, text string")
    found = sketches.versions(df).localCheckpoint()
    sketched = found.withColumn("s_next", sketches.sketch(F.col("next")))
    for kind in sketches.KINDS:
        cells = sketched.select("doc_id", F.lit(sketches.CELLS).alias("m"), F.posexplode(F.arrays_zip("s_own", f"s_{kind}")).alias("j", "x"))
        cells = cells.select("doc_id", "m", "j", (F.col("x.s_own.n") - F.col(f"x.s_{kind}.n")).alias("n"), *[
            F.col(f"x.s_own.{c}").bitwiseXOR(F.col(f"x.s_{kind}.{c}")).alias(c) for c in ("k", "c")
        ])
        rounds = {r["doc_id"]: r for r in sketches.peel(cells, ["doc_id"], 0, 2).collect()}
        got = found.select("doc_id", "own", F.col(kind).alias("other"), F.col(f"first_{kind}").alias("first")).collect()
        for r in got:
            assert (r["first"] is None) == (rounds[r["doc_id"]]["left"] > 0)
            if r["first"] is not None:
                own, other = set(r["own"]), set(r["other"])
                wanted = sorted([(d, 1) for d in own - other] + [(d, -1) for d in other - own])
                assert sorted((x["found"], x["n"]) for x in r["first"]) == wanted
                assert sorted((x["found"], x["n"]) for x in rounds[r["doc_id"]]["digests"]) == wanted
        settled = sum(r["first"] is not None for r in got)
        assert 10 < settled < len(got)


def test_last_join_moves_no_sets(spark, small):
    """The sets and differences of documents are not shuffled for the query's result: sizes are."""
    from tidemark.llm.queries import QUERIES

    nodes, joins = [QUERIES["op10_fingerprints"](spark, small)._jdf.queryExecution().optimizedPlan()], 0
    while nodes:
        node = nodes.pop()
        children = [node.children().apply(i) for i in range(node.children().size())]
        if node.getClass().getSimpleName() == "Join":
            joins += 1
            for child in children:
                kinds = [child.output().apply(i).dataType().simpleString() for i in range(child.output().size())]
                assert not [k for k in kinds if k == "array<bigint>" or k.startswith("array<struct<found")]
        nodes += children
    assert joins


def test_retries_broadcast_few_open_rows(spark, monkeypatch):
    """A second retry finds its rows by their keys alone, without another shuffle of all sets."""
    rows = [(i, "\n".join(f"{i} line {j}" for j in range(200))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    plans = []
    real = sketches.store

    def seen(frame, name, *args):
        plans.append((name, frame._jdf.queryExecution().optimizedPlan().toString()))
        return real(frame, name, *args)

    # Sketches of one cell a table: the first retry settles nothing of this size.
    whole = sketches.peel
    monkeypatch.setattr(sketches, "store", seen)
    monkeypatch.setattr(sketches, "peel", lambda cells, keys, seed, sweeps: whole(cells, keys, seed, sweeps if seed > 1 else 0))
    got = sketches.fingerprints(df).collect()
    assert len(got) == 40 and {r["near_next"] for r in got} == {0.0}
    retries = [plan for name, plan in plans if name == "differences"]
    assert len(retries) >= 2 and "Join" not in retries[0] and "broadcast" in retries[1]
