"""Line dedup: lines repeated over documents go, except in the last document that holds them.

Two Bloom filters, of once-seen and twice-seen line hashes, find the lines that may repeat. Only these are
shuffled, as 16-byte digests with their document's id, for exact counts and the choice of the document that
keeps them. Only documents with a suspected line are shuffled for their rewriting.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z lower-cased. Keys stand by their
128-bit XXH3 digest.

Defined results: a null or empty text is one empty line; rows with equal ids count as one document, and all of
them keep its lines; rows without id count as one document that is never the last one; an empty table gives an
empty result; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import repeats
from tidemark.llm.common import SPACES, fresh, join_weighted, parts_of, store, text_of

MIN_CHARS = 40
MIN_DOCS = 5
_FRAME = SPACES.encode()


def line_keys(text: str | None, min_chars: int = MIN_CHARS) -> list[bytes | None]:
    """Digest of every line's key, None for keys too short to count."""
    out: list[bytes | None] = []
    for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n"):
        key = line.strip(_FRAME).lower()
        long = len(key) >= min_chars and (
            len(key) >= 4 * min_chars or len(key.decode("utf-8", "surrogatepass")) >= min_chars
        )
        out.append(xxhash.xxh3_128_digest(key) if long else None)
    return out


def _distinct(batch: pa.RecordBatch, column: str, min_chars: int) -> list[list[bytes]]:
    return [
        list(dict.fromkeys(k for k in line_keys(t, min_chars) if k is not None))
        for t in batch.column(column).to_pylist()
    ]


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), np.uint64)[::2] if keys else np.zeros(0, np.uint64)


def with_suspects(docs: DataFrame, column: str, min_chars: int) -> DataFrame:
    """``docs`` with ``column``: the digests of a document's lines that other documents may hold too."""
    lines = docs.agg(F.sum(F.size(F.split(text_of(), "\n"))).alias("n")).first()["n"] or 0
    bits = repeats.bits_for(lines)

    def hashes_of(batch: pa.RecordBatch) -> np.ndarray:
        return _hashes([k for keys in _distinct(batch, "text", min_chars) for k in keys])

    twice = repeats.twice_filter(docs.select("text"), hashes_of, bits)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches, "text"):
            keys = _distinct(batch, "text", min_chars)
            hit = iter(repeats.suspected(_hashes([k for ks in keys for k in ks]), twice.value, bits).tolist())
            marks = [[k for k in ks if next(hit)] for ks in keys]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(marks, pa.list_(pa.binary()))], names=[*batch.schema.names, column]
            )

    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.ArrayType(T.BinaryType()))])
    return docs.mapInArrow(mark, schema)


def _rewrite(text: str | None, drop: set[bytes], min_chars: int) -> tuple[str, int]:
    lines = (text or "").split("\n")
    kept = [x for x, k in zip(lines, line_keys(text, min_chars), strict=True) if k not in drop]
    return "\n".join(kept), len(lines) - len(kept)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the kept text, ``n_lines`` before dropping and ``n_dropped``."""
    docs = docs.select(*[c for c in docs.columns if c not in ("n_lines", "n_dropped")])
    marks = fresh("_marks", docs.columns)
    drops_name = fresh("_drops", docs.columns)
    marked = with_suspects(docs, marks, min_chars)
    slim = suspect_pairs(marked, marks)
    pairs = store(slim, "line-suspects")
    counts = pairs.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("holder"))
    losers = store(counts.where(F.col("n") >= min_docs), "line-losers")
    losing = join_weighted(pairs, losers, "key", "n", pairs.count(), "inner").where(~F.col("doc_id").eqNullSafe(F.col("holder")))
    drops = losing.groupBy("doc_id").agg(F.collect_list("key").alias(drops_name)).withColumnRenamed("doc_id", "_id")

    n_lines = F.size(F.split(text_of(), "\n")).cast("long").alias("n_lines")
    others = [c for c in docs.columns if c != "text"]
    clean = marked.where(F.size(marks) == 0).select(
        *others, text_of().alias("text"), n_lines, F.lit(0).cast("long").alias("n_dropped")
    )
    suspects = marked.where(F.size(marks) > 0).drop(marks)
    joined = suspects.join(drops, suspects["doc_id"].eqNullSafe(drops["_id"]), "left").select(*suspects.columns, n_lines, drops_name)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches, "text"):
            names = batch.schema.names
            done = [
                _rewrite(t, set(d or ()), min_chars) if d else (t or "", 0)
                for t, d in zip(batch.column("text").to_pylist(), batch.column(drops_name).to_pylist(), strict=True)
            ]
            columns = [batch.column(c) for c in others]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([x[0] for x in done], pa.string()), batch.column("n_lines"),
                 pa.array([x[1] for x in done], pa.int64())],
                names=[*others, "text", "n_lines", "n_dropped"],
            )

    kinds = {f.name: f for f in docs.schema.fields}
    schema = T.StructType([
        *[kinds[c] for c in others], T.StructField("text", T.StringType()),
        T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()),
    ])
    out = clean.unionByName(joined.mapInArrow(rewrite, schema))
    return out.select(*docs.columns, "n_lines", "n_dropped")


def suspect_pairs(marked: DataFrame, marks: str) -> DataFrame:
    """Distinct (key, doc_id) of the suspected lines."""
    return marked.select("doc_id", F.explode(marks).alias("key")).distinct()
