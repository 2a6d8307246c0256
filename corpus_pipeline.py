"""The corpus pipeline: quality rules, line dedup, near-dedup, long-match dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and reread as the next
stage's ``docs``. All but the last return the columns of ``documents``; where a stage changes texts, ``n_chars``
follows them.

Defined results, for every stage: a null or empty text is an empty one (the quality rules reject it); rows without id
and rows with equal ids are documents of their own, except that of a group of near copies one row stays, that with
the smallest id, fingerprint and text; a null source is no host; other columns pass through whatever their names; an
empty table gives an empty one.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidemark.llm import lines, packing, quality, simhash, substrings  # noqa: E402
from tidemark.llm.common import store, table  # noqa: E402


def _like(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """The columns of ``docs`` from ``changed``, with the length of the new text."""
    return changed.select(*[
        F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns
    ])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and their host's verdict keep."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that later documents repeat."""
    return _like(docs, lines.dedup_lines(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group whose SimHash fingerprints link within two bits."""
    return simhash.keep_one(docs)


def long_match_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of long passages that start earlier."""
    return _like(docs, substrings.dedup_substrings(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("long_match_dedup", long_match_dedup),
    ("packing", pack),
]

#: Tokenization and the fingerprints have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
