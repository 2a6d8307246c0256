import heapq
import random
import re
import string
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from tidemark.llm import huffman, idfiles, tokens
from tidemark.session import run_dir


def huffman_cost(counts):
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a + b
        heapq.heappush(heap, a + b)
    return cost


@pytest.mark.parametrize("counts", [[5], [0, 3, 0, 9], [1] * 7, list(range(1, 60)), [2 ** i for i in range(16)]])
def test_lengths_are_the_best(counts):
    counts = np.array(counts)
    lengths = huffman.code_lengths(counts, 18)
    used = lengths[counts > 0].astype(int)
    assert (lengths[counts == 0] == 0).all() and (2.0 ** -used).sum() <= 1
    if len(used) > 1:
        assert (used * counts[counts > 0]).sum() == huffman_cost(counts)


def test_lengths_keep_their_limit():
    counts = np.array([2 ** i for i in range(40)])
    lengths = huffman.code_lengths(counts, 8)
    assert lengths.max() == 8 and (2.0 ** -lengths.astype(int)).sum() <= 1
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(20), 4)


@pytest.mark.parametrize("n", [1, 127, 128, 129, 5000])
def test_streams_come_back(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 9000)
    lengths = huffman.code_lengths(np.bincount(ids))
    payload, marks = huffman.encode(ids, lengths, huffman.canonical(lengths))
    counts = np.full(len(marks), huffman.CHECKPOINT)
    counts[-1] = n - huffman.CHECKPOINT * (len(marks) - 1)
    decoder = huffman.Decoder(lengths)
    stream = np.frombuffer(payload, np.uint8)
    assert np.array_equal(decoder.decode(stream, marks, counts), ids)
    # Any checkpoint is a beginning of its own.
    k = len(marks) // 2
    part = decoder.decode(stream, marks[k:k + 1], counts[k:k + 1])
    assert np.array_equal(part, ids[k * huffman.CHECKPOINT:][: counts[k]])


def expected(rows):
    encoder = tokens.Encoder(tokens.BYTE_VOCABULARY)
    ids = [np.append(x, 2).astype("<u4") for x in encoder.encode([t for _, t in rows])]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    out, start = [], 0
    for i in order:
        out.append((rows[i][0], start, len(ids[i]), zlib.crc32(ids[i].tobytes()), ids[i].tobytes()))
        start += len(ids[i])
    return out


def read_back(spark, rows, monkeypatch=None):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    folder = run_dir(spark, "ids")
    idfiles.write(df, folder)
    got = idfiles.read(spark, folder).collect()
    return sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"], bytes(r["ids"])) for r in got), key=lambda r: r[1])


def test_files_equal_direct_encoding(spark, monkeypatch):
    monkeypatch.setattr(idfiles, "BLOCK_IDS", 300)
    monkeypatch.setattr(idfiles, "DECODE_IDS", 1_000)
    rows = [(i * 13 % 101, f"text number {i} " * (i % 9) + "né\n" * (i % 4)) for i in range(101)]
    rows += [(200, None), (201, ""), (-5, "x " * 3000), (None, "no id")]
    assert read_back(spark, rows) == expected(rows)


def test_empty(spark):
    assert read_back(spark, []) == []


def test_whole_table(spark, small):
    from tidemark.llm.queries import QUERIES

    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op6_id_files"](spark, small).collect()
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got) == [x[:4] for x in expected(rows)]


class Frame:
    """Stands for a frame: gives the function that it would run over Arrow batches."""

    def select(self, *_):
        return self

    def mapInArrow(self, run, _):  # noqa: N802
        return run


def test_a_batch_is_tokenized_in_parts(spark):
    texts = ["some words again and again " * 40_000, None, "", *["other words, repeated " * 20_000] * 12, "é " * 3_000_000, "last"]
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    at = 0
    found = []
    for out in idfiles.raw_ids(Frame(), tokens.BYTE_VOCABULARY)(iter([batch, batch.slice(0, 0)])):
        size = sum(len((t or "").encode()) for t in texts[at:at + out.num_rows])
        assert out.num_rows == 1 or size <= 4 << 20
        at += out.num_rows
        found += zip(*(out.column(c).to_pylist() for c in ("doc_id", "ids")), strict=True)
    library = tokens.Encoder(tokens.BYTE_VOCABULARY).library
    want = [np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u2").tobytes() for t in texts]
    assert found == list(enumerate(want))


def own_memory():
    """MB of this process without files."""
    return int(re.search(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="memory is read from /proc")
def test_a_worker_keeps_no_unused_memory(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices(string.ascii_lowercase, k=8)) for _ in range(100_000)]
    texts = [" ".join(rng.choices(words, k=200)) for _ in range(6_000)]
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    for _ in idfiles.raw_ids(Frame(), tokens.BYTE_VOCABULARY)(iter([batch])):
        pass
    held = own_memory()
    pa.default_memory_pool().release_unused()
    assert held - own_memory() < 20
