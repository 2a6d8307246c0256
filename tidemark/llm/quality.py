"""Quality rules: base rules per document, then host verdicts from failure rates shrunk by an empirical beta prior.

Only DataFrame functions: words, windows and lines stay arrays inside their row, so nothing is shuffled
but one count row per host and task.

Defined results: a null text has no words and fails; a document without host (null ``source``) is judged by
the base rules alone; repeated rows count once each; an empty table gives an empty result. Other columns pass
through; a clashing one of the names below is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, fresh, join_weighted, text_of
from tidemark.operators.sizes import BROADCAST_BYTES, measured_bytes

WINDOW = 5
METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


@dataclass(frozen=True)
class Rules:
    """Fewest words; percent of words in repeated windows; shrunk failure rate beyond which a host goes."""

    min_words: int = 10
    max_repeat_percent: int = 20
    max_host_rate: float = 0.5


def _repeat_words(hashes: Column, pairs: Column) -> Column:
    """Words covered by windows whose hash appears at least twice. ``pairs``: (hash, start), sorted."""
    twice = F.filter(
        pairs, lambda p, k: (F.get(pairs, k - 1)["h"] == p["h"]) | F.coalesce(F.get(pairs, k + 1)["h"] == p["h"], F.lit(False))
    )
    starts = F.array_sort(F.transform(twice, lambda p: p["i"]))
    zero = F.struct(F.lit(-WINDOW).alias("at"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        starts, zero,
        lambda a, i: F.struct(i.alias("at"), (a["n"] + F.least(F.lit(WINDOW), i - a["at"])).alias("n")),
        lambda a: a["n"],
    )


def with_metrics(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``docs`` with the base metrics and ``base_failed``."""
    kept = [c for c in docs.columns if c not in METRICS]
    all_words, windows, sorted_windows = "_words", "_windows", "_sorted"
    trimmed = F.btrim(text_of(), F.lit(SPACES))
    frame = docs.select(*kept).withColumn(
        all_words,
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+")),
    )
    words = F.col(all_words)
    count = F.size(words)
    frame = frame.withColumn(
        windows,
        F.when(count < WINDOW, F.array().cast("array<bigint>")).otherwise(
            F.transform(
                F.sequence(F.lit(0), count - WINDOW),
                lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]),
            )
        ),
    )
    pairs = F.transform(F.col(windows), lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    frame = frame.withColumn(
        sorted_windows,
        F.when(F.size(F.array_distinct(windows)) < F.size(windows), F.array_sort(pairs)),
    )
    lines = F.filter(F.split(text_of(), "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    frame = frame.withColumn("_lines", lines)
    repeated = F.when(F.col(sorted_windows).isNull(), F.lit(0).cast("long")).otherwise(
        _repeat_words(F.col(windows), F.col(sorted_windows))
    )
    return frame.select(
        *kept,
        count.cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count(text_of(), F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated.alias("n_repeat_words"),
    ).withColumn(
        "base_failed",
        (F.col("n_words") < rules.min_words)
        | (F.col("n_repeat_words") * 100 > F.col("n_words") * rules.max_repeat_percent),
    )


def host_rates(metrics: DataFrame) -> DataFrame:
    """Per host: documents ``n``, failures ``f``, and their rate shrunk towards the corpus.

    The beta prior has the mean of all documents and the strength that explains the spread between hosts
    beyond chance (method of moments, held within 2 and 10,000 documents).
    """
    hosts = metrics.where(F.col("source").isNotNull()).groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("f")
    )
    at = hosts.agg(
        F.sum("n").alias("n"), F.sum("f").alias("f"), F.count(F.lit(1)).alias("h"),
        F.sum(F.col("f") * F.col("f") / F.col("n")).alias("ff"),
    ).first()
    n, f, h, ff = at["n"] or 0, at["f"] or 0, at["h"] or 0, at["ff"] or 0.0
    mean = f / n if n else 0.0
    spread = (ff - n * mean * mean) / n if n else 0.0
    chance = mean * (1 - mean) * h / n if n else 0.0
    strength = mean * (1 - mean) / max(spread - chance, 1e-12) - 1
    strength = min(max(strength, 2.0), 10_000.0)
    return hosts.withColumn("rate", (F.col("f") + F.lit(mean * strength)) / (F.col("n") + F.lit(strength)))


def with_verdicts(metrics: DataFrame, hosts: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``metrics`` with ``kept``: base rules passed, and the host not rejected.

    Rejected hosts are broadcast if they measure small. Else those that hold over 1/1000 of the documents, at most
    1000, are broadcast, and the others joined by a shuffle of their small groups.
    """
    rejected = hosts.where(F.col("rate") > rules.max_host_rate).select("source", "n", F.lit(True).alias("_rejected"))
    kept = [c for c in metrics.columns if c != "kept"]
    base = metrics.select(*kept)
    if measured_bytes(rejected.select("source", "n")) <= BROADCAST_BYTES:
        both = base.join(F.broadcast(rejected.drop("n")), "source", "left")
    else:
        total = hosts.agg(F.sum("n").alias("n")).first()["n"] or 0
        both = join_weighted(base.where("source IS NOT NULL"), rejected, "source", "n", total, "left").select(*kept, "_rejected")
        both = both.unionByName(base.where("source IS NULL").withColumn("_rejected", F.lit(None).cast("boolean")))
    return both.select(*kept, (~F.col("base_failed") & F.col("_rejected").isNull()).alias("kept"))


def keep_good(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that the base rules and their host's verdict keep, with the columns of ``docs``."""
    # A filter would be moved below the metrics and repeat them inside each other; it is not moved below a row number.
    row = fresh("_row", docs.columns)
    aside = {c: fresh(f"_own_{c}", docs.columns) for c in docs.columns if c in (*METRICS, "kept")}
    metrics = with_metrics(docs.withColumnsRenamed(aside), rules).withColumn(row, F.monotonically_increasing_id())
    judged = with_verdicts(metrics, host_rates(metrics), rules)
    return judged.where(F.col("kept") & (F.col(row) >= 0)).select(
        *[F.col(aside.get(c, c)).alias(c) for c in docs.columns]
    )
