"""Suffix-array dedup on a run-length index: bytes of 100-byte strings that also start earlier are removed.

Every 100-byte window has a least 32-byte hash, at the same place in windows of equal bytes. Neighbouring windows
with their least hash at one place of the text form a segment, so a window can only equal windows of other
segments under the same hash. Two Bloom filters find the hashes that may repeat; only their segments are shuffled, as digests:

- segments equal to an earlier one are removed whole, whatever their bytes;
- of segments that differ under one hash, the bytes of the first of each kind go to a run-length index: buckets of
  about ``BUCKET_BYTES`` with whole hashes in each, a run-compressed Burrows-Wheeler transform per bucket, matching
  statistics streamed over it, matches of 100 bytes marked behind the earliest;
- hashes with over ``CROWDED`` kinds of segments (contexts of one common passage) would not fit a bucket; their
  windows are compared by 128-bit digests, which any number of tasks share.

Defined results: a null text has no bytes; documents without id come first; rows with equal ids are one document
in the order, so equal places of theirs are not earlier than each other; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import repeats
from tidemark.llm.common import fresh, join_weighted, parts_of, store, text_of
from tidemark.llm.runindex import RunIndex

LENGTH = 100
GRAM = 32
#: Windows taken at once from a text, and a power of two beyond the places in them.
CHUNK = 1 << 19
PLACES = 1 << 20
CROWDED = 2_048
BUCKET_BYTES = 1 << 20
_FIRST = -(1 << 63)


def segments(raw: bytes, length: int = LENGTH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(start, windows, least hash) of the segments of a text, chunk by chunk."""
    total = len(raw) - length + 1
    for at in range(0, max(total, 0), CHUNK):
        n = min(CHUNK, total - at)
        h = np.frombuffer(raw, np.uint8, n + length - 1, at).astype(np.uint64) + np.uint64(1)
        odd, span = 0x9E3779B97F4A7C15, 1
        with np.errstate(over="ignore"):
            while span < GRAM:
                h = h[:-span] * np.uint64(odd) + h[span:]
                odd, span = odd * odd % (1 << 64), span * 2
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
        # The place in the low bits: of equal hashes the leftmost is least.
        low = (h & ~np.uint64(PLACES - 1)) | np.arange(len(h), dtype=np.uint64)
        width, span = length - GRAM + 1, 1
        while span * 2 <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < width:
            low = np.minimum(low[:span - width], low[width - span:])
        starts = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
        sizes = np.diff(np.r_[starts, n])
        yield starts + at, sizes, h[low[starts] & np.uint64(PLACES - 1)]


def _raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _batch(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in columns.values()], names=list(columns))


def suspect_segments(rows: DataFrame, length: int) -> DataFrame:
    """(ord, tid, a, n, cid): segments whose least hash may repeat. ``cid``: the hash and a digest of the bytes."""
    total = rows.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    bits = repeats.bits_for(total // 34)

    def hashes_of(batch: pa.RecordBatch) -> np.ndarray:
        found = [h for t in batch.column("text").to_pylist() for _, _, h in segments(_raw(t), length)]
        return np.concatenate(found) if found else np.zeros(0, np.uint64)

    twice = repeats.twice_filter(rows.select("text"), hashes_of, bits)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_digest
        for batch in parts_of(batches, "text"):
            out: list[list] = [[], [], [], [], []]
            for ord_, tid, text in zip(*[batch.column(c).to_pylist() for c in ("ord", "tid", "text")], strict=True):
                raw = _raw(text)
                for a, n, h in segments(raw, length):
                    hit = repeats.suspected(h, twice.value, bits)
                    a, n, keys = a[hit].tolist(), n[hit].tolist(), h[hit].astype(">u8").tobytes()
                    out[0] += [ord_] * len(a)
                    out[1] += [tid] * len(a)
                    out[2] += a
                    out[3] += n
                    out[4] += [
                        keys[8 * i:8 * i + 8] + digest(raw[s:s + w + length - 1])
                        for i, (s, w) in enumerate(zip(a, n, strict=True))
                    ]
            if out[0]:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield _batch(dict(zip(("ord", "tid", "a", "n", "cid"), zip(out, kinds, strict=True), strict=True)))

    return rows.mapInArrow(find, "ord long, tid long, a long, n long, cid binary")


def _index_bucket(length: int):
    def mark(group: pa.Table) -> pa.Table:
        ords, tids, starts, sizes, strings = (group[c].to_pylist() for c in ("ord", "tid", "a", "n", "bytes"))
        index = RunIndex(strings, length)
        sizes_ = np.array(sizes, np.int64)
        owner = np.repeat(np.arange(len(strings)), sizes_)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(sizes_) - sizes_, sizes_)
        head = index.classes()[index.begins[owner] + inner]
        place = np.array(starts, np.int64)[owner] + inner
        ord_ = np.array(ords, np.int64)[owner]
        order = np.lexsort((place, ord_))
        step = np.r_[0, (ord_[order][1:] != ord_[order][:-1]) | (place[order][1:] != place[order][:-1])]
        rank = np.empty(len(owner), np.int64)
        rank[order] = np.cumsum(step)
        least = np.full(index.n, len(owner), np.int64)
        np.minimum.at(least, head, rank)
        later = np.flatnonzero(rank > least[head])
        # Runs of marked windows within one segment.
        new = np.r_[True, (np.diff(later) > 1) | (np.diff(owner[later]) > 0)] if len(later) else np.zeros(0, bool)
        first = later[np.flatnonzero(new)]
        last = later[np.r_[np.flatnonzero(new)[1:] - 1, len(later) - 1]] if len(later) else first
        return pa.table({
            "ord": pa.array(ord_[first], pa.int64()), "tid": pa.array(np.array(tids, np.int64)[owner[first]], pa.int64()),
            "a": pa.array(place[first], pa.int64()), "z": pa.array(place[last], pa.int64()),
        })

    return mark


def _key() -> Column:
    return F.substring("cid", 1, 8)


def repeated_windows(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """(ord, tid, a, z): runs of window starts whose bytes also start earlier. ``rows``: ord, tid, text."""
    found = store(suspect_segments(rows, length), "segments")
    groups = found.groupBy("cid").agg(F.min(F.struct("ord", "a", "tid", "n")).alias("x"), F.count(F.lit(1)).alias("cnt"))
    kinds = store(groups.select("cid", _key().alias("key"), "cnt", *[F.col(f"x.{c}").alias(f"f_{c}") for c in ("ord", "a", "tid", "n")]), "segment-kinds")
    copied = kinds.where("cnt > 1").select("cid", "cnt", "f_ord", "f_a")
    equal = join_weighted(found, copied, "cid", "cnt", found.count(), "inner")
    whole = equal.where("ord <> f_ord OR a <> f_a").select("ord", "tid", "a", (F.col("a") + F.col("n") - 1).alias("z"))

    keys = store(kinds.groupBy("key").agg(F.count(F.lit(1)).alias("k")).where("k > 1"), "mixed-hashes")
    mixed = join_weighted(kinds, keys, "key", "k", kinds.count(), "inner")
    wanted = mixed.groupBy(F.col("f_ord").alias("ord"), F.col("f_tid").alias("tid")).agg(
        F.collect_list(F.struct(F.col("f_a").alias("a"), F.col("f_n").alias("n"), "key", (F.col("k") > CROWDED).alias("crowded"))).alias("parts")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for ord_, tid, text, parts in zip(*[batch.column(c).to_pylist() for c in ("ord", "tid", "text", "parts")], strict=True):
                raw = _raw(text)
                out += [
                    (ord_, tid, p["a"], p["n"], p["key"], p["crowded"], raw[p["a"]:p["a"] + p["n"] + length - 1])
                    for p in parts
                ]
            kinds_ = [*[pa.int64()] * 4, pa.binary(), pa.bool_(), pa.binary()]
            names = ("ord", "tid", "a", "n", "key", "crowded", "bytes")
            yield _batch({c: (list(v), k) for c, v, k in zip(names, zip(*out, strict=True), kinds_, strict=True)})

    contents = rows.join(wanted, ["ord", "tid"]).mapInArrow(
        cut, "ord long, tid long, a long, n long, key binary, crowded boolean, bytes binary")
    contents = store(contents, "segment-bytes", "zstd")
    light = contents.where("NOT crowded")
    size = light.agg(F.sum(F.octet_length("bytes")).alias("b")).first()["b"] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    indexed = light.groupBy(F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket")).applyInArrow(
        _index_bucket(length), "ord long, tid long, a long, z long")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            out = [
                (ord_, tid, a + i, digest(raw[i:i + length]))
                for ord_, tid, a, n, raw in zip(*[batch.column(c).to_pylist() for c in ("ord", "tid", "a", "n", "bytes")], strict=True)
                for i in range(n)
            ]
            if out:
                kinds_ = [*[pa.int64()] * 3, pa.binary()]
                yield _batch({c: (list(v), k) for c, v, k in zip(("ord", "tid", "a", "w"), zip(*out, strict=True), kinds_, strict=True)})

    crowd = store(contents.where("crowded").mapInArrow(windows, "ord long, tid long, a long, w binary"), "crowded-windows")
    firsts = crowd.groupBy("w").agg(F.min(F.struct("ord", "a")).alias("x"), F.count(F.lit(1)).alias("n"))
    firsts = store(firsts.where("n > 1").select("w", "n", F.col("x.ord").alias("f_ord"), F.col("x.a").alias("f_a")), "crowded-firsts")
    later = join_weighted(crowd, firsts, "w", "n", crowd.count(), "inner").where("ord <> f_ord OR a <> f_a")
    single = later.select("ord", "tid", "a", F.col("a").alias("z"))
    return whole.unionByName(indexed).unionByName(single)


def without_spans(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, int, int]:
    """The bytes outside the spans, the number of bytes inside and of maximal spans."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.r_[True, starts[1:] > reach[:-1]]
    begin = starts[new]
    end = reach[np.r_[np.flatnonzero(new)[1:] - 1, len(starts) - 1]]
    edges = [0, *np.stack([begin, end], 1).ravel().tolist(), len(raw)]
    return b"".join(raw[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2)), int((end - begin).sum()), len(begin)


def dedup_substrings(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` without its repeated bytes: ``kept`` (binary), ``n_bytes``, ``n_removed``, ``n_spans`` are added.

    ``text`` becomes the kept bytes as text; characters cut by a span's edge are left out of it.
    """
    added = ["kept", "n_bytes", "n_removed", "n_spans"]
    docs = docs.select(*[c for c in docs.columns if c not in added])
    ord_, tid, spans = (fresh(c, docs.columns) for c in ("_ord", "_tid", "_spans"))
    keyed = docs.withColumn(ord_, F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST))).withColumn(tid, F.xxhash64(text_of()))
    rows = keyed.select(F.col(ord_).alias("ord"), F.col(tid).alias("tid"), "text")
    marks = repeated_windows(rows, length)
    grouped = marks.groupBy(F.col("ord").alias(ord_), F.col("tid").alias(tid)).agg(
        F.collect_list(F.struct("a", "z")).alias(spans))
    joined = keyed.join(grouped, [ord_, tid], "left").select(*docs.columns, spans)

    names = docs.columns

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, kept, counts = [], [], []
            for text, marks_ in zip(batch.column("text").to_pylist(), batch.column(spans).to_pylist(), strict=True):
                raw = _raw(text)
                rest, removed, n = raw, 0, 0
                if marks_:
                    starts = np.array([m["a"] for m in marks_], np.int64)
                    ends = np.array([m["z"] for m in marks_], np.int64) + length
                    rest, removed, n = without_spans(raw, starts, ends)
                kept.append(rest)
                texts.append(rest.decode("utf-8", "ignore") if removed else text or "")
                counts.append((len(raw), removed, n))
            columns = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in names]
            numbers = [pa.array([c[i] for c in counts], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(kept, pa.binary()), *numbers], names=[*names, *added])

    schema = T.StructType([
        *docs.schema.fields, T.StructField("kept", T.BinaryType()), *[T.StructField(c, T.LongType()) for c in added[1:]],
    ])
    return joined.mapInArrow(remove, schema)
