"""Packing of tokenized documents into sequences of a fixed window.

Documents are cut at whole windows; every remainder is one piece. Piece lengths are counted in steps of
``STEP`` tokens. Non-negative least squares fits repeat counts of shallow combinations (one to three lengths that
fill the window exactly) to this histogram; the counts are rounded down, and what is left is packed greedily,
largest first, still on the histogram. So the driver only sees counts by length. The plan, a few thousand rows
at most, gives each rank within a length its sequence; pieces learn their rank from counts per task.

Defined results: a null or empty text is one end id; repeated rows and ids are packed as documents of their own;
an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import parts_of, store
from tidemark.llm.tokens import END_ID, WORD_VOCABULARY, encoder

WINDOW = 4096
STEP = 16

#: Combinations that enter the fit at once.
BLOCK = 8

Pattern = tuple[int, ...]


def combinations(window: int, present: np.ndarray) -> np.ndarray:
    """Rows of up to three lengths (0: none) that sum to ``window``, of those that are ``present``."""
    rows = [(window, 0, 0)] if present[window] else []
    for a in np.flatnonzero(present[1:]).tolist():
        a += 1
        rest = window - a
        if 0 < rest <= a and present[rest]:
            rows.append((a, rest, 0))
        b = np.arange((rest + 1) // 2, min(a, rest - 1) + 1)
        b = b[present[b] & present[rest - b]] if len(b) else b
        rows += [(a, x, rest - x) for x in b.tolist()]
    return np.array(rows, np.int64).reshape(-1, 3)


def nnls(rows: np.ndarray, goal: np.ndarray, tolerance: float = 1e-6) -> np.ndarray:
    """Repeat counts x >= 0 of the combinations that come closest to ``goal`` (active sets)."""
    n = len(rows)
    x = np.zeros(n)
    size = len(goal)
    scale = max(float(goal.max(initial=0)), 1.0)
    goal = goal / scale
    active = np.zeros(n, bool)

    def columns(which: np.ndarray) -> np.ndarray:
        out = np.zeros((size, len(which)))
        for k in range(3):
            np.add.at(out, (rows[which, k], np.arange(len(which))), 1.0)
        out[0] = 0
        return out

    for _ in range(3 * size):
        residual = goal.copy()
        for k in range(3):
            residual -= np.bincount(rows[:, k], x, size)
        residual[0] = 0
        gain = residual[rows].sum(1)
        gain[active] = -1
        best = np.argsort(-gain, kind="stable")[:BLOCK]
        best = best[gain[best] > max(tolerance, 0.5 * gain[best[0]] if n else 0)]
        if not len(best):
            break
        active[best] = True
        while True:
            which = np.flatnonzero(active)
            a = columns(which)
            solved = np.linalg.solve(a.T @ a + 1e-9 * np.eye(len(which)), a.T @ goal)
            if solved.min() > 0:
                x[:] = 0
                x[which] = solved
                break
            low = solved <= 0
            old = x[which]
            share = np.min(old[low] / np.maximum(old[low] - solved[low], 1e-300))
            old = old + share * (solved - old)
            # Those that the fit pushes below zero leave; at least one of them is at zero now.
            gone = low & (old <= 1e-9)
            old[gone] = 0
            x[:] = 0
            x[which] = old
            active[which[gone]] = False
            if not active.any():
                break
    return x * scale


def greedy(counts: np.ndarray, window: int) -> list[tuple[Pattern, int]]:
    """Packs the counted lengths largest first; equal fillings are planned together."""
    counts = counts.copy()
    out = []
    while counts.any():
        used: dict[int, int] = {}
        room, pattern = window, []
        top = window
        while room:
            fits = np.flatnonzero(counts[:min(room, top) + 1])
            fits = fits[fits > 0]
            if not len(fits):
                break
            b = int(fits[-1])
            take = min(room // b, int(counts[b]) - used.get(b, 0))
            if not take:
                top = b - 1
                continue
            used[b] = used.get(b, 0) + take
            pattern += [b] * take
            room -= take * b
            top = b - 1
        repeats = min(int(counts[b]) // k for b, k in used.items())
        for b, k in used.items():
            counts[b] -= k * repeats
        out.append((tuple(pattern), repeats))
    return out


def plan(histogram: dict[int, int], window: int) -> list[tuple[Pattern, int]]:
    """(lengths of one sequence, number of such sequences), covering the histogram exactly."""
    counts = np.zeros(window + 1, np.int64)
    for b, n in histogram.items():
        counts[b] = n
    rows = combinations(window, counts > 0)
    x = nnls(rows, counts.astype(float))
    out = []
    for i in np.argsort(-x, kind="stable").tolist():
        pattern = tuple(b for b in rows[i].tolist() if b)
        need = {b: pattern.count(b) for b in pattern}
        repeats = min(int(x[i]), *(int(counts[b]) // k for b, k in need.items()))
        if repeats > 0:
            out.append((pattern, repeats))
            for b, k in need.items():
                counts[b] -= k * repeats
    return out + greedy(counts, window)


def token_pieces(docs: DataFrame, vocabulary: str, window: int, step: int) -> DataFrame:
    """Pieces of all documents with their length class ``bucket`` and their ``rank`` in it within task ``pid``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, ranks = TaskContext.get().partitionId(), {}
        encode = encoder(vocabulary).encode
        for part in parts_of(batches, "text"):
            rows = []
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), encode(part.column("text").to_pylist()), strict=True):
                raw = np.append(ids, ids.dtype.type(END_ID)).astype("<u4")
                for start in range(0, len(raw), window):
                    piece = raw[start:start + window]
                    bucket = -(-len(piece) // step)
                    rank = ranks.get(bucket, 0)
                    ranks[bucket] = rank + 1
                    rows.append((pid, bucket, rank, doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(raw)))
            kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 6]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                names=["pid", "bucket", "rank", "doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    schema = "pid int, bucket int, rank long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, schema)


def pack(docs: DataFrame, vocabulary: str = WORD_VOCABULARY, window: int = WINDOW, step: int = STEP) -> DataFrame:
    """Per piece: its document, place, crc, and its sequence and offset there."""
    pieces = store(token_pieces(docs, vocabulary, window, step), "pieces")
    per_task = store(pieces.groupBy("pid", "bucket").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = {r["bucket"]: r["n"] for r in per_task.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    ranges: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequences = 0
    for pattern, repeats in plan(histogram, window // step):
        for slot, b in enumerate(pattern):
            at = taken.get(b, 0)
            ranges.setdefault(b, []).append((at, sequences, slot))
            taken[b] = at + repeats
        sequences += repeats
    lookup = {b: tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) for b, rows in ranges.items()}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets = batch.column("bucket").to_numpy()
            ranks = batch.column("rank").to_numpy() + batch.column("before").to_numpy()
            sequence, slot = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            for b in np.unique(buckets).tolist():
                at, bases, slots = lookup[b]
                rows = np.flatnonzero(buckets == b)
                k = np.searchsorted(at, ranks[rows], side="right") - 1
                sequence[rows] = bases[k] + ranks[rows] - at[k]
                slot[rows] = slots[k]
            keep = [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(sequence), pa.array(slot)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "slot"],
            )

    before = Window.partitionBy("bucket").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("pid", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, slot long"
    placed = pieces.join(bases, ["pid", "bucket"]).mapInArrow(assign, schema)
    order = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(order), F.lit(0))).drop("slot")
