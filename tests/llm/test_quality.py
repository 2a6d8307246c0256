import re
from collections import Counter

from pyspark.sql import functions as F
from tidemark.llm import quality

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    times = Counter(windows)
    covered = {j for i, x in enumerate(windows) if times[x] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


TEXTS = [
    None, "", " \t\x0b ", "one", "a b c d e " * 4, "a b c d e f g a b c d e", "x " * 30, "l one\nl one\n\n \nl one\r", "#*$%&|<>é 中\x0b文\x1f",
    " ".join(f"w{i}" for i in range(400)) + " q r s t u v q r s t u", "a b c", "ab c d e f a bc d e f",
]


def test_metrics_equal_brute_force(spark):
    df = spark.createDataFrame([(i, t, "h", -1) for i, t in enumerate(TEXTS)], "doc_id long, text string, source string, n_words int")
    got = {r["doc_id"]: tuple(r[c] for c in quality.METRICS) for r in quality.with_metrics(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}


def good(i):
    return " ".join(f"word{i}x{j}" for j in range(20))


def test_hosts(spark):
    """A host of failures takes its clean document along; a small host is pulled to the corpus; null hosts are free."""
    rows = [(i, "bad", "junk") for i in range(60)] + [(100, good(1), "junk"), (101, good(2), None), (102, "bad", None)]
    rows += [(200 + i, good(i), f"h{i % 40}") for i in range(400)] + [(700, "bad", "h700")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    metrics = quality.with_metrics(df)
    kept = {r["doc_id"] for r in quality.with_verdicts(metrics, quality.host_rates(metrics)).where("kept").collect()}
    assert kept == {101, *range(200, 600)}
    out = quality.keep_good(df)
    assert out.columns == df.columns and {r["doc_id"] for r in out.collect()} == kept


def test_a_lone_failure_does_not_condemn_its_host(spark):
    rows = [(i, good(i), f"h{i % 50}") for i in range(1000)] + [(2000, "bad", "one"), (2001, good(7), "one")]
    metrics = quality.with_metrics(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    rate = quality.host_rates(metrics).where(F.col("source") == "one").first()["rate"]
    assert rate < 0.5


def test_own_columns_stay(spark):
    df = spark.createDataFrame([(1, good(1), "h", -7, "x")], "doc_id long, text string, source string, n_words int, kept string")
    assert [tuple(r) for r in quality.keep_good(df).collect()] == [(1, good(1), "h", -7, "x")]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert quality.keep_good(df).count() == 0


def test_no_python_on_the_way(spark):
    from conftest import plan_of

    df = spark.createDataFrame([(1, "a", "h")], "doc_id long, text string, source string")
    assert not re.search("Python|Arrow|Pandas", plan_of(quality.keep_good(df)))
