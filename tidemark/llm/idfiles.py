"""Token-id files: ids of whole texts in ascending order of document, Huffman coded in independent blocks.

A dataset is a folder of Parquet files, file i holding the i-th range of document ids. A row is a block: the
documents it holds whole, their numbers of ids, the coded ids and a bit offset for every 128th id, so a reader
can start anywhere. The code comes from the counts of all ids; its lengths lie beside the blocks.

Documents are tokenized once, into a stored table of raw ids; counts and coding read that table.

Defined results: a null or empty text has the end id alone; documents without id come first; documents with
equal ids follow in order of their ids' bytes; an empty table gives an empty dataset.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import huffman
from tidemark.llm.common import parts_of, store
from tidemark.llm.tokens import BYTE_VOCABULARY, END_ID, encoder

BLOCK_IDS = 1 << 16
#: Ids decoded together.
DECODE_IDS = 1 << 21
_BLOCK = (
    "part int, block int, local_start long, doc_ids array<long>, n_ids array<long>, payload binary, "
    "checkpoints array<long>"
)


def raw_ids(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, width, ids) with ids as little-endian integers of ``width`` bytes, the end id last."""

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        for rows in parts_of(batches, "text"):
            ids = [np.append(x, x.dtype.type(END_ID)) for x in encode(rows.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array([x.itemsize for x in ids], pa.int32()),
                 pa.array([x.tobytes() for x in ids], pa.binary())],
                names=["doc_id", "width", "ids"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        tokenize, "doc_id long, width int, ids binary")


def _arrays(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [
        np.frombuffer(raw, f"<u{width}")
        for width, raw in zip(batch.column("width").to_pylist(), batch.column("ids").to_pylist(), strict=True)
    ]


def id_counts(ids: DataFrame) -> np.ndarray:
    """How often every id occurs; one row per id and task reaches the sum."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)

        for rows in parts_of(batches, "ids"):
            new = np.bincount(np.concatenate([np.zeros(0, np.uint16), *_arrays(rows)]))
            if len(new) > len(total):
                total, new = new.astype(np.int64), total
            total[: len(new)] += new
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["id", "n"])

    rows = ids.select("width", "ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(max((r["id"] for r in rows), default=-1) + 1, np.int64)
    for r in rows:
        out[r["id"]] = r["n"]
    return out


def write(docs: DataFrame, folder: str, vocabulary: str = BYTE_VOCABULARY) -> None:
    """Writes the dataset: ``folder``/blocks and ``folder``/code."""
    spark = docs.sparkSession
    ids = store(raw_ids(docs, vocabulary), "raw-ids", "zstd")
    lengths = huffman.code_lengths(id_counts(ids))
    codes = huffman.canonical(lengths)

    def block(part: int, number: int, start: int, docs_: list, arrays: list[np.ndarray]) -> pa.RecordBatch:
        payload, checkpoints = huffman.encode(np.concatenate(arrays), lengths, codes)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([start], pa.int64()),
                pa.array([docs_], pa.list_(pa.int64())), pa.array([[len(a) for a in arrays]], pa.list_(pa.int64())),
                pa.array([payload], pa.binary()), pa.array([checkpoints.tolist()], pa.list_(pa.int64())),
            ],
            names=["part", "block", "local_start", "doc_ids", "n_ids", "payload", "checkpoints"],
        )

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, start, size = TaskContext.get().partitionId(), 0, 0, 0
        held: list[np.ndarray] = []
        names: list[int | None] = []
        for rows in parts_of(batches, "ids"):
            for doc_id, ids_ in zip(rows.column("doc_id").to_pylist(), _arrays(rows), strict=True):
                held.append(ids_)
                names.append(doc_id)
                size += len(held[-1])
                if size >= BLOCK_IDS:
                    yield block(part, number, start, names, held)
                    number, start, size, held, names = number + 1, start + size, 0, [], []
        if held:
            yield block(part, number, start, names, held)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = ids.repartitionByRange(parts, F.col("doc_id").asc_nulls_first())
    ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "ids").mapInArrow(code, _BLOCK).write.parquet(f"{folder}/blocks")
    # As an Arrow table: rows of Python objects would go through Python workers of another kind, which would stay.
    spark.createDataFrame(pa.table({"lengths": pa.array([lengths.tobytes()], pa.binary())})).write.parquet(f"{folder}/code")


def read(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) decoded from the files; ``start`` counts all ids before the document."""
    lengths = np.frombuffer(bytes(spark.read.parquet(f"{folder}/code").first()["lengths"]), np.uint8)
    blocks = spark.read.schema(_BLOCK).parquet(f"{folder}/blocks")
    last = F.max_by(F.struct("local_start", "n_ids"), "block")
    ends = blocks.groupBy("part").agg(last.alias("x")).select(
        "part", (F.col("x.local_start") + F.aggregate("x.n_ids", F.lit(0).cast("long"), lambda a, n: a + n)).alias("n")
    )
    bases, total = {}, 0
    for part, n in sorted((r["part"], r["n"]) for r in ends.collect()):
        bases[part], total = total, total + n
    table = None

    def decode_rows(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        nonlocal table
        if table is None:
            table = huffman.Decoder(lengths)
        streams, starts, counts, offset = [], [], [], 0
        for r in rows:
            streams.append(np.frombuffer(r["payload"], np.uint8))
            marks = np.array(r["checkpoints"], np.int64)
            starts.append(marks + 8 * offset)
            sizes = np.full(len(marks), huffman.CHECKPOINT, np.int64)
            sizes[-1] = sum(r["n_ids"]) - huffman.CHECKPOINT * (len(marks) - 1)
            counts.append(sizes)
            offset += len(streams[-1])
        ids = table.decode(np.concatenate(streams), np.concatenate(starts), np.concatenate(counts)).astype("<u4")
        out, end = [], 0
        for r in rows:
            start = bases[r["part"]] + r["local_start"]
            for doc_id, n in zip(r["doc_ids"], r["n_ids"], strict=True):
                raw = ids[end:end + n].tobytes()
                out.append((doc_id, start, n, zlib.crc32(raw), raw if with_ids else None))
                end, start = end + n, start + n
        kinds = [*[pa.int64()] * 4, pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
            names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
        )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for rows in parts_of(batches, "payload"):
            for r in rows.to_pylist():
                held.append(r)
                size += sum(r["n_ids"])
                if size >= DECODE_IDS:
                    yield from decode_rows(held)
                    held, size = [], 0
        if held:
            yield from decode_rows(held)

    return blocks.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")
