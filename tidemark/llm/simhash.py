"""SimHash near-dedup by multi-index hashing.

A fingerprint is cut into two 32-bit segments. Two fingerprints that differ in at most two bits differ in at
most one bit of the first segment, or in none of the second: each segment value's ball of that radius is
enumerated, the segment's table is asked for every member, and the complete distance of what it holds is verified.

A table bucket is only paired through while it is small. Fingerprints of a crowded bucket, and those that would
ask it, are compared through the ball of radius one around the complete fingerprint instead: two fingerprints
differ in at most two bits exactly if these balls share a member, and at most 65 fingerprints share one. So no
group is paired with itself, and no link is lost.

Components run over distinct fingerprints; copies join by their fingerprint.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; a null text has none and the fingerprint zero,
which links like any other; fewer words than a shingle make one shingle; rows without id never name a component
unless no row of it has one; rows with equal ids keep their own fingerprints.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import HEAVY_SHARE, fresh, store
from tidemark.llm.graphs import components

SHINGLE = 3
SEED = 42
MAX_DISTANCE = 2
SEGMENT_BITS = 32
#: Radius of the ball in each segment; radii plus one sum to one more than the distance.
RADII = (1, 0)
#: A bucket with more fingerprints than this is not paired through.
CROWDED = 64
_SPACE = re.compile(rb"[\x20\x09-\x0D]+")
#: Shingles counted together.
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits: each set if it is set in over half of the shingles' XXH64 hashes."""
    words = [w for w in _SPACE.split((text or "").encode("utf-8", "surrogatepass").lower()) if w]
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.r_[0, ends[:-1] + 1]
    n = max(1, len(words) - shingle + 1)
    spans = zip(begins[:n].tolist(), ends[len(words) - n:].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, CHUNK):
        part = hashes[i:i + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, column: str, keep_text: bool = True) -> DataFrame:
    """``docs`` with the fingerprint as a signed long in ``column``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64).view(np.int64)
            names = [c for c in batch.schema.names if keep_text or c != "text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(prints)], names=[*names, column])

    fields = [f for f in docs.schema.fields if keep_text or f.name != "text"]
    return docs.mapInArrow(add, T.StructType([*fields, T.StructField(column, T.LongType())]))


def _ball(value: Column, bits: int) -> Column:
    """The value and all values that differ from it in one of its lowest ``bits`` bits."""
    flips = [value.bitwiseXOR(F.lit(1 << b if b < 63 else -(1 << 63)).cast("long")) for b in range(bits)]
    return F.array(value, *flips)


def _segments(fp: Column) -> list[Column]:
    return [F.shiftrightunsigned(fp, SEGMENT_BITS), fp.bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1))]


def _keyed(segment: int, keys: Column) -> Column:
    return F.transform(keys, lambda k: F.struct(F.lit(segment).alias("s"), k.alias("key")))


def _near(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= MAX_DISTANCE


def links(prints: DataFrame) -> DataFrame:
    """Links (u, v) between distinct fingerprints ``fp`` whose components are those of all pairs within two bits."""
    parts = _segments(F.col("fp"))
    entries = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(s).alias("s"), p.alias("key")) for s, p in enumerate(parts)
    ])).alias("x")).select("x.s", "x.key", "fp")
    asks = prints.select("fp", F.explode(F.concat(*[
        _keyed(s, _ball(p, SEGMENT_BITS * radius)) for s, (p, radius) in enumerate(zip(parts, RADII, strict=True))
    ])).alias("x")).select("x.s", "x.key", F.col("fp").alias("other"))

    sizes = entries.groupBy("s", "key").agg(F.count(F.lit(1)).alias("n"))
    crowded = store(sizes.where(F.col("n") > CROWDED).select("s", "key"), "crowded")
    small = entries.join(crowded, ["s", "key"], "left_anti")
    found = asks.join(small, ["s", "key"]).where((F.col("fp") < F.col("other")) & _near("fp", "other"))
    pairs = found.select(F.col("fp").alias("u"), F.col("other").alias("v"))
    if crowded.isEmpty():
        return pairs

    asking = asks.join(crowded, ["s", "key"], "left_semi").select(F.col("other").alias("fp"))
    hot = store(asking.distinct(), "crowded-prints")
    around = hot.select("fp", F.explode(_ball(F.col("fp"), 64)).alias("member"))
    shared = around.groupBy("member").agg(F.collect_list("fp").alias("all")).where(F.size("all") > 1)
    met = shared.select(F.array_min("all").alias("u"), F.explode("all").alias("v")).where("u <> v")
    return pairs.unionByName(met.where(_near("u", "v")))


def grouped(prints: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(fp, first, n, component) of every distinct fingerprint: its smallest id, its rows, a fingerprint that names
    its component; and (node, component) of those with links. ``prints``: doc_id, fp."""
    nodes = store(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "prints")
    members = components(links(nodes.select("fp")))
    named = nodes.join(members.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    return named, members


def classes(prints: DataFrame) -> DataFrame:
    """(fp, n, component_id) of every distinct fingerprint. ``prints``: doc_id, fp."""
    named, members = grouped(prints)
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    # A class of one fingerprint names itself; only the others meet under their component.
    several = members.select("component").distinct()
    alone = named.join(several, "component", "left_anti").select("fp", "n", F.col("first").alias("component_id"))
    meeting = named.join(several, "component", "left_semi").select("fp", "n", "component").join(smallest, "component")
    return store(alone.unionByName(meeting.select("fp", "n", "component_id")), "classes")


def with_class(rows: DataFrame, found: DataFrame, fp: str) -> DataFrame:
    """``rows`` with ``component_id``. Fingerprints with over 1/1000 of the rows are at most 1000 and are broadcast."""
    total = found.agg(F.sum("n").alias("n")).first()["n"] or 0
    named = found.withColumnRenamed("fp", fp)
    heavy = F.col("n") * HEAVY_SHARE > total
    hot = F.broadcast(named.where(heavy).select(fp, "component_id"))
    rest = named.where(~heavy).select(fp, "component_id")
    cold = rows.join(hot.select(fp), fp, "left_anti")
    return rows.join(hot, fp).unionByName(cold.join(rest, fp))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document: its fingerprint ``fp`` (signed long) and the smallest id of its component."""
    prints = with_fingerprint(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "fp", keep_text=False)
    prints = store(prints, "simhash")
    return with_class(prints, classes(prints), "fp")


def staying(docs: DataFrame, marked: DataFrame, named: DataFrame, fp: str) -> DataFrame:
    """One row of every component: of its rows that with the smallest id (none last), fingerprint and text.

    ``marked``: ``docs`` with the fingerprint in ``fp``. ``named``: the first of what ``grouped`` returns.
    """
    rank = fresh("_rank", marked.columns)
    first = F.min(F.struct(F.col("first").isNull().alias("none"), "first", "fp")).alias("x")
    stays = named.groupBy("component").agg(first).select(F.col("x.first").alias("_id"), F.col("x.fp").alias("_stay"))
    met = marked.join(stays, F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col(fp) == F.col("_stay")), "inner")
    order = Window.partitionBy("_stay").orderBy("text")
    return met.withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1).select(*docs.columns)


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of every component, whatever ids the rows of other components have."""
    fp = fresh("_fp", docs.columns)
    prints = with_fingerprint(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "fp", keep_text=False)
    return staying(docs, with_fingerprint(docs, fp), grouped(store(prints, "simhash"))[0], fp)
