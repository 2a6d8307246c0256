"""URL filters: fixed rules first, then a tree of path templates per host, judged by the labels of its pages.

A path is a list of segments. Level by level, a segment stays as it is if it leads to at least two different paths and
to one in ``LITERAL`` of those under its parent; any other becomes a wildcard that tells digits, letters and the
file ending only. Siblings whose labels are better explained by one rate of clean pages than by two are merged,
nearest rates first, and their subtrees with them. The purity of a branch is its share of clean labelled pages, shrunk
towards the purity of its parent, a host's towards that of all pages; a template whose purity is under
``LEAST_PURITY`` is rejected.

Segments from the ``LEVELS``-th on are one segment. The siblings under a parent are at most ``LITERAL`` literals, the
wildcards and the end of the path, so they are merged in one place; everything else is counted in Spark, and keys that
hold many rows are joined by broadcast.

Defined results: a null url, or one without ``://``, has an empty host and path and is judged like others of its kind;
pages without labels count for templates, not for purity; labels with a null are none, repeated ones count each;
repeated rows are judged each; an empty table gives an empty result; columns other than ``page_id`` and ``url`` are left out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import groupby
from math import lgamma
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import join_weighted, store

LEVELS = 8
LITERAL = 100
#: Labelled pages that the purity of the parent is worth.
STRENGTH = 4.0
LEAST_PURITY = 0.5
# Endings of page addresses that a wildcard keeps.
ENDINGS = ("html", "htm", "php", "asp", "aspx", "jsp", "xml", "json", "txt", "pdf", "jpg", "jpeg", "png", "gif")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_END = "$"


class Rule(NamedTuple):
    """``verdict`` for urls of ``host`` and its subdomains whose path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def rule(verdict: str, name: str) -> Rule:
    """From a text like ``example.org/en/``."""
    host, path = name.split("/", 1)
    return Rule(verdict, host, "/" + path)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def by_rules(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, of equally long ones that with the longer host; else null."""
    name = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), len(r.host))):
        fits = r.fits(host, path)
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def _segments(path: Column) -> Column:
    parts = F.when(path == "", F.array().cast("array<string>")).otherwise(F.split(F.substring(path, 2, 1 << 30), "/", -1))
    rest = F.array(F.array_join(F.slice(parts, LEVELS, F.greatest(F.size(parts), F.lit(1))), "/"))
    return F.when(F.size(parts) > LEVELS, F.concat(F.slice(parts, 1, LEVELS - 1), rest)).otherwise(parts)


def _wildcard(segment: Column) -> Column:
    ending = F.regexp_extract(segment, rf"(\.(?:{'|'.join(ENDINGS)}))\z", 1)
    stem = F.regexp_replace(segment, rf"\.(?:{'|'.join(ENDINGS)})\z", "")
    kind = F.when(stem.rlike(r"^[0-9]+\z"), "digits").when(stem.rlike(r"^[A-Za-z]+\z"), "letters").otherwise("mixed")
    return F.concat(F.lit("*"), kind, ending)


def templates(paths: DataFrame) -> DataFrame:
    """``paths`` (distinct host and path) with ``template``: a list of ``=literal`` and ``*wildcard`` segments."""
    rest = paths.withColumn("segments", _segments(F.col("path"))).withColumn("template", F.array().cast("array<string>"))
    rest, ready = store(rest, "paths"), []
    for level in range(LEVELS + 1):
        # Paths that end here are ready; all lie in one table, written once a level.
        ready.append(rest.where(F.size("segments") <= level).drop("segments"))
        rest = rest.where(F.size("segments") > level)
        total = rest.count()
        if not total:
            break
        keyed = rest.withColumn("key", F.struct("host", "template", F.col("segments")[level].alias("segment")))
        counts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        counts = counts.withColumn("parent", F.struct("key.host", "key.template"))
        repeated = F.col("n") >= 2
        parents = counts.groupBy("parent").agg(F.sum("n").alias("total"), F.count_if(repeated).alias("candidates"))
        literals = join_weighted(counts.where(repeated), parents, "parent", "candidates", total, "inner")
        literals = store(literals.where(F.col("n") * LITERAL >= F.col("total")).select("key", "n"), "literals")
        segment = F.col("key.segment")
        step = F.when(F.col("n").isNotNull(), F.concat(F.lit("="), segment)).otherwise(_wildcard(segment))
        rest = join_weighted(keyed, literals, "key", "n", total, "left")
        rest = store(rest.withColumn("template", F.concat("template", F.array(step))).drop("key", "n"), "paths")
    out = ready[0]
    for part in ready[1:]:
        out = out.unionByName(part)
    return store(out, "templates")


def _evidence(good: float, bad: float, purity: float) -> float:
    """Log likelihood of the labels under a rate of its own, drawn around ``purity``."""
    a, b = STRENGTH * purity, STRENGTH * (1 - purity)
    return lgamma(a + good) + lgamma(b + bad) - lgamma(a + b + good + bad) - lgamma(a) - lgamma(b) + lgamma(a + b)


def shrunk(good: float, bad: float, purity: float) -> float:
    return (good + STRENGTH * purity) / (good + bad + STRENGTH)


def merge_siblings(branches: list[tuple[str, int, int]], purity: float) -> dict[str, tuple[str, float]]:
    """(name, good, bad) of the branches under a parent of ``purity``: the merged branch of each, and its purity.

    Of neighbours by purity those gain most from one common rate are merged, as long as any gain. A merged branch has
    the least name of its members.
    """
    groups = [([name], good, bad) for name, good, bad in branches]
    groups.sort(key=lambda g: (shrunk(g[1], g[2], purity), g[0]))
    while len(groups) > 1:
        gains = [
            _evidence(g[1] + h[1], g[2] + h[2], purity) - _evidence(g[1], g[2], purity) - _evidence(h[1], h[2], purity)
            for g, h in zip(groups, groups[1:], strict=False)
        ]
        best = max(range(len(gains)), key=lambda i: (gains[i], -i))
        if gains[best] <= 1e-9:
            break
        g, h = groups[best:best + 2]
        groups[best:best + 2] = [(g[0] + h[0], g[1] + h[1], g[2] + h[2])]
    return {name: (min(names), shrunk(good, bad, purity)) for names, good, bad in groups for name in names}


_MERGED = "host string, place array<string>, branch string, merged string, purity_below double"


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Siblings come one after another, in any number of batches."""

    def rows() -> Iterator[dict]:
        for batch in batches:
            yield from batch.to_pylist()

    out: list[tuple] = []
    for (host, place), those in groupby(rows(), key=lambda r: (r["host"], r["place"])):
        those = list(those)
        merged = merge_siblings([(r["branch"], r["good"], r["bad"]) for r in those], those[0]["purity"])
        out += [(host, place, r["branch"], *merged[r["branch"]]) for r in those]
        if len(out) >= 10_000:
            yield _merged_rows(out)
            out = []
    yield _merged_rows(out)


def _merged_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.list_(pa.string()), pa.string(), pa.string(), pa.float64()]
    names = ["host", "place", "branch", "merged", "purity_below"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def purities(counted: DataFrame) -> DataFrame:
    """(host, template, n_paths, merged_template, purity) of templates with numbers of ``good`` and ``bad`` labels."""
    total = counted.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()
    overall = shrunk(total["good"] or 0, total["bad"] or 0, LEAST_PURITY)
    hosts = counted.groupBy("host").agg(F.sum("good").alias("g"), F.sum("bad").alias("b"))
    hosts = hosts.select("host", ((F.col("g") + STRENGTH * overall) / (F.col("g") + F.col("b") + STRENGTH)).alias("purity"))
    rest = counted.join(hosts, "host").withColumn("place", F.array().cast("array<string>"))
    rest, ready = store(rest.withColumn("steps", F.concat("template", F.array(F.lit(_END)))), "branches"), []
    for level in range(LEVELS + 2):
        ready.append(rest.where(F.size("steps") <= level))
        rest = rest.where(F.size("steps") > level)
        if rest.isEmpty():
            break
        rest = rest.withColumn("branch", F.col("steps")[level])
        branches = rest.groupBy("host", "place", "branch").agg(
            F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.max("purity").alias("purity")
        )
        merged = branches.repartition("host", "place").sortWithinPartitions("host", "place").mapInArrow(_merge, _MERGED)
        rest = rest.join(store(merged, "merged"), ["host", "place", "branch"]).withColumn("purity", F.col("purity_below"))
        rest = rest.withColumn("place", F.concat("place", F.array("merged"))).drop("branch", "merged", "purity_below")
        rest = store(rest, "branches")
    out = ready[0]
    for part in ready[1:]:
        out = out.unionByName(part)
    merged_template = F.array_join(F.slice("place", 1, F.greatest(F.size("place") - 1, F.lit(0))), "/")
    return out.select("host", "template", "n_paths", merged_template.alias("merged_template"), "purity")


def judge(pages: DataFrame, labels: DataFrame, rules: Sequence[Rule] = ()) -> DataFrame:
    """(page_id, url, host, path, rule, template, purity, verdict) of all ``pages``.

    ``labels`` (page_id, clean) tells of some pages whether they are clean.
    """
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    clean = labels.where("page_id IS NOT NULL").groupBy("page_id").agg(
        F.count_if(F.col("clean")).alias("good"), F.count_if(~F.col("clean")).alias("bad")
    )
    counted = parsed.join(clean, "page_id", "left").groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n_pages"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("good", "bad")],
    )
    paths = templates(counted)
    total = paths.agg(F.sum("n_pages").alias("pages"), F.count(F.lit(1)).alias("paths")).first()
    trees = store(paths.groupBy("host", "template").agg(
        F.count(F.lit(1)).alias("n_paths"), F.sum("good").alias("good"), F.sum("bad").alias("bad")
    ), "trees")
    key = F.struct("host", "template").alias("key")
    known = store(purities(trees).select(key, "n_paths", "merged_template", "purity"), "purities")
    judged = join_weighted(paths.select("host", "path", "n_pages", key), known, "key", "n_paths", total["paths"], "inner")
    judged = store(judged.select(
        F.struct("host", "path").alias("key"), "n_pages", F.col("merged_template").alias("template"), "purity"
    ), "judged")
    name, verdict = by_rules(F.col("host"), F.col("path"), rules)
    rows = parsed.withColumns({"rule": name, "by_rule": verdict, "key": F.struct("host", "path")})
    rows = join_weighted(rows, judged, "key", "n_pages", total["pages"] or 0, "left")
    by_method = F.when(F.col("purity") < LEAST_PURITY, "block").otherwise("allow")
    return rows.select(
        "page_id", "url", "host", "path", "rule", "template", "purity", F.coalesce("by_rule", by_method).alias("verdict")
    )
