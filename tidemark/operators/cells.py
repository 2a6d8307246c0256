"""Cells of unit vectors: a tree of balanced cells, bounds on a cell's best score, and the search inside cells.

The tree is learned from a bounded sample; every row is then placed, by as many dot products as the tree is deep.
Corpus rows lie in one cell each and are never copied. A cell with more rows than a task should hold is cut into
parts by a hash of the ids. In a task the rows of a part come first and queries stream past them, so a query side of
any size needs no blocks.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sizes import BROADCAST_BYTES
from tidemark.session import stable

# The search travels with its functions: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows the tree is learned from, at most on average.
LEARN_ROWS = 50_000
#: Scores held at once.
STRIP = 1_000_000
#: Questions (a query and a part it asks) made at once.
ASKED_ROWS = 20_000
#: Bins of a search that gathers cells, at least, so that small and large corpora ask alike.
MIN_BINS = 8
HITS = "query_id long, id long, score double"
#: Slack of the bounds, far above rounding.
_SLACK = 1e-9


def unit(rows: Sequence) -> np.ndarray:
    """Vectors as rows of unit length; a zero vector stays zero and scores 0."""
    m = np.stack([np.asarray(r, dtype=np.float64) for r in rows])
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def first_k(q: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Per query the k best rows: score descending, id ascending."""
    order = np.lexsort((ids, -scores, q))
    q, ids, scores = q[order], ids[order], scores[order]
    at = np.arange(len(q))
    opens = np.ones(len(q), dtype=bool)
    opens[1:] = q[1:] != q[:-1]
    keep = at - np.maximum.accumulate(np.where(opens, at, 0)) < k
    return q[keep], ids[keep], scores[keep]


def best(scores: np.ndarray, k: int, order: np.ndarray | slice = slice(None)) -> np.ndarray:
    """Marks the ``k`` best of every row; of those that tie with the last one, the first in ``order``."""
    n = scores.shape[1]
    if n <= k:
        return np.ones(scores.shape, bool)
    floor = np.partition(scores, n - k, axis=1)[:, [n - k]]
    chosen = scores >= floor
    crowded = np.flatnonzero(np.count_nonzero(chosen, axis=1) > k)
    if len(crowded):
        above, tied = scores[crowded] > floor[crowded], (scores[crowded] == floor[crowded])[:, order]
        left = k - np.count_nonzero(above, axis=1)
        above[:, order] |= tied & (np.cumsum(tied, axis=1, dtype=np.int32) <= left[:, None])
        chosen[crowded] = above
    return chosen


def search(queries: np.ndarray, corpus: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query row, id, score) of the k best corpus rows per query row.

    Scores are made in strips of bounded size and rounded, so equal vectors tie exactly.
    """
    n = len(corpus)
    strip = max(1, STRIP // max(1, n))
    found, by_id = [], np.argsort(ids, kind="stable")
    for start in range(0, len(queries), strip):
        scores = queries[start:start + strip] @ corpus.T
        np.round(scores, 12, out=scores)
        if n > k:
            row, at = np.nonzero(best(scores, k, by_id))
        else:
            row, at = (a.ravel() for a in np.indices(scores.shape))
        found.append(first_k(row + start, ids[at], scores[row, at], k))
    return tuple(np.concatenate(part) for part in zip(*found))


class CellTree(NamedTuple):
    """Node i has the children 2i + 1 and 2i + 2; rows beyond its threshold along its direction go to the latter.

    Cells are the leaves, numbered from the left; one more cell holds zero vectors, which have no direction.
    """

    directions: np.ndarray
    thresholds: np.ndarray
    centers: np.ndarray

    @property
    def depth(self) -> int:
        return (len(self.thresholds) + 1).bit_length() - 1

    @property
    def cells(self) -> int:
        return len(self.centers)

    def place(self, x: np.ndarray) -> np.ndarray:
        """The cell of every row."""
        node = np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            beyond = np.einsum("nd,nd->n", x, self.directions[node]) > self.thresholds[node]
            node = 2 * node + 1 + beyond
        return np.where(x.any(axis=1), node - len(self.thresholds), self.cells)

    def angles(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """The angle between a row and its cell's center; 0 for zero vectors."""
        inside = cell < self.cells
        dots = np.einsum("nd,nd->n", x, self.centers[np.where(inside, cell, 0)])
        return np.where(inside, np.arccos(np.clip(dots, -1, 1)), 0.0)

    def probe(self, q: np.ndarray, probes: int) -> np.ndarray:
        """The ``probes`` cells that look best for each query, best first.

        Twice as many nodes are followed down the tree, those whose thresholds the query misses by least; of the
        leaves reached those with the nearest centers are taken.
        """
        width = min(self.cells, 2 * probes)
        nodes, missed = np.zeros((len(q), 1), np.int64), np.zeros((len(q), 1))
        for _ in range(self.depth):
            margin = np.einsum("nd,ncd->nc", q, self.directions[nodes]) - self.thresholds[nodes]
            low, high = np.maximum(margin, 0) ** 2, np.maximum(-margin, 0) ** 2
            nodes = np.concatenate([2 * nodes + 1, 2 * nodes + 2], axis=1)
            missed = np.concatenate([missed + low, missed + high], axis=1)
            if nodes.shape[1] > width:
                best = np.argpartition(missed, width - 1, axis=1)[:, :width]
                nodes, missed = np.take_along_axis(nodes, best, 1), np.take_along_axis(missed, best, 1)
        cells = nodes - len(self.thresholds)
        near = np.einsum("nd,ncd->nc", q, self.centers[cells])
        return np.take_along_axis(cells, np.argsort(-near, axis=1, kind="stable"), 1)[:, :probes]

    def bounds(self, q: np.ndarray, radii: np.ndarray) -> np.ndarray:
        """The best score that any row of each cell, zero vectors included, can have with each query.

        Angles between unit vectors obey the triangle inequality: a row within ``radius`` of the center is at least
        the query's angle to the center less that radius away. A radius below 0 marks an empty cell.
        """
        apart = np.arccos(np.clip(q @ self.centers.T, -1, 1)) - radii[:self.cells]
        best = np.cos(np.clip(apart, 0, np.pi))
        best[~q.any(axis=1)] = 0.0
        best = np.concatenate([best, np.zeros((len(q), 1))], axis=1)
        return np.where(radii >= 0, best + _SLACK, -np.inf)


def learn_tree(x: np.ndarray, depth: int) -> CellTree:
    """Splits at the median along the line between two means, level by level, so cells are even."""
    width = x.shape[1] if len(x) else 1
    nodes = (1 << depth) - 1
    directions, thresholds = np.zeros((nodes, width)), np.zeros(nodes)
    rows = {0: np.arange(len(x))}
    for node in range(nodes):
        mine = x[rows[node]]
        if len(mine) > 1:
            directions[node] = _axis(mine)
            along = mine @ directions[node]
            thresholds[node] = np.median(along)
            right = along > thresholds[node]
        else:
            right = np.zeros(len(mine), bool)
        rows[2 * node + 1], rows[2 * node + 2] = rows[node][~right], rows[node][right]
        del rows[node]
    centers = np.stack([x[rows[nodes + i]].mean(axis=0) if len(rows[nodes + i]) else np.zeros(width) for i in range(nodes + 1)])
    norm = np.linalg.norm(centers, axis=1, keepdims=True)
    return CellTree(directions, thresholds, np.divide(centers, norm, out=np.zeros_like(centers), where=norm > 0))


def _axis(x: np.ndarray) -> np.ndarray:
    """The direction between two means, from the farthest rows on; any direction if all rows are one."""
    a = x[np.argmax(((x - x.mean(axis=0)) ** 2).sum(axis=1))]
    b = x[np.argmax(((x - a) ** 2).sum(axis=1))]
    for _ in range(4):
        to_a = ((x - a) ** 2).sum(axis=1) < ((x - b) ** 2).sum(axis=1)
        if to_a.all() or not to_a.any():
            break
        a, b = x[to_a].mean(axis=0), x[~to_a].mean(axis=0)
    size = np.linalg.norm(a - b)
    return (a - b) / size if size > 0 else np.zeros(x.shape[1])


class Cells(NamedTuple):
    """A corpus in cells: ``rows`` (cell, part, bin, id, cv), the tree, and of every cell its radius, its number of
    parts and its first bin."""

    rows: DataFrame
    tree: CellTree
    radii: np.ndarray
    parts: np.ndarray
    bins: np.ndarray


def bin_cells(sizes: Sequence[int], parts: Sequence[int], rows_per_bin: int) -> np.ndarray:
    """The first bin of every cell.

    Neighbouring cells share a bin up to ``rows_per_bin`` rows; a cell of several parts has a bin for each.
    """
    bins, now, held = np.zeros(len(sizes), np.int64), 0, 0
    for cell, (n, p) in enumerate(zip(sizes, parts, strict=True)):
        if held and held + n > rows_per_bin:
            now, held = now + 1, 0
        bins[cell], held = now, held + n
        if p > 1:
            now, held = now + p, 0
    return bins


def in_cells(corpus: DataFrame, n: int, rows_per_cell: int, cells: int | None = None, seed: int = 42) -> Cells:
    """``corpus`` (id, cv), ``n`` rows, in about n / ``rows_per_cell`` cells (or ``cells``, a power of two or the next).

    The tree goes to every task; its size is bounded, and beyond it cells hold more rows, in parts.
    """
    spark = corpus.sparkSession
    learned = corpus.sample(min(1.0, LEARN_ROWS / max(1, n)), seed).select("cv").collect()
    x = unit([r["cv"] for r in learned]) if learned else np.zeros((0, 1))
    wanted = cells or max(1, -(-n // rows_per_cell))
    most = int(math.log2(max(2, BROADCAST_BYTES // (32 * x.shape[1]))))
    tree = learn_tree(x, min(most, (wanted - 1).bit_length()) if len(x) else 0)
    shared = spark.sparkContext.broadcast(tree)  # at most half of BROADCAST_BYTES

    @F.pandas_udf("struct<cell: int, angle: double>")
    def place(vectors: pd.Series) -> pd.DataFrame:
        if vectors.empty:
            return pd.DataFrame({"cell": pd.Series(dtype="int32"), "angle": pd.Series(dtype="float64")})
        v, t = unit(vectors), shared.value
        cell = t.place(v)
        return pd.DataFrame({"cell": cell.astype(np.int32), "angle": t.angles(v, cell)})

    placed = stable(corpus.withColumn("at", place("cv")).select("id", "cv", "at.cell", "at.angle"))
    sizes = placed.groupBy("cell").agg(F.max("angle").alias("radius"), F.count(F.lit(1)).alias("n")).collect()
    radii, parts, held = np.full(tree.cells + 1, -1.0), np.zeros(tree.cells + 1, np.int64), np.zeros(tree.cells + 1, np.int64)
    for r in sizes:  # one row per cell
        radii[r["cell"]], parts[r["cell"]], held[r["cell"]] = r["radius"], -(-r["n"] // rows_per_cell), r["n"]
    bins = bin_cells(held, parts, min(rows_per_cell, -(-n // MIN_BINS)))
    numbers = spark.createDataFrame(
        [(i, int(p), int(b)) for i, (p, b) in enumerate(zip(parts, bins, strict=True)) if p], "cell int, parts long, first int"
    )
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    rows = placed.join(F.broadcast(numbers), "cell").withColumn("part", part)  # one row per cell
    return Cells(rows.select("cell", "part", (F.col("first") + F.col("part")).alias("bin"), "id", "cv"), tree, radii, parts, bins)


def _runs(batch: pd.DataFrame, names: Sequence[str] = ("cell", "part", "side")) -> Iterator[pd.DataFrame]:
    """Rows of a batch by cell, part and side, which lie together."""
    keys = batch[list(names)].to_numpy()
    cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
    for start, end in zip([0, *cuts], [*cuts, len(batch)], strict=True):
        yield batch.iloc[start:end]


def search_cells(asked: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of every (cell, part) that a query asks.

    ``asked``: cell, part, query_id, qv; ``corpus``: cell, part, id, cv.
    """
    here = corpus.select("cell", "part", F.lit(0).alias("side"), "id", "cv", F.lit(None).cast(dict(asked.dtypes)["qv"]).alias("qv"))
    there = asked.select(
        "cell", "part", F.lit(1).alias("side"), F.col("query_id").alias("id"),
        F.lit(None).cast(dict(corpus.dtypes)["cv"]).alias("cv"), "qv",
    )
    rows = here.unionByName(there)
    placed = rows.repartition("cell", "part").sortWithinPartitions("cell", "part", "side")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, ids, held, vectors = None, [], [], None
        for batch in batches:
            if batch.empty:
                continue
            for part in _runs(batch):
                cell, number, side = part[["cell", "part", "side"]].iloc[0]
                if (cell, number) != now:
                    now, ids, held, vectors = (cell, number), [], [], None
                if side == 0:
                    ids.append(part["id"].to_numpy())
                    held.append(unit(part["cv"]))
                elif ids:
                    if vectors is None:
                        vectors, names = np.concatenate(held), np.concatenate(ids)
                        held = []
                    row, found, scores = search(unit(part["qv"]), vectors, names, k)
                    yield pd.DataFrame({"query_id": part["id"].to_numpy()[row], "id": found, "score": scores})

    return placed.mapInPandas(run, HITS)


def _in_bin(
    queries: np.ndarray, cells: pd.Series, k: int, wanted: int, vectors: np.ndarray, coded: np.ndarray, members: dict[int, np.ndarray]
) -> Iterator[tuple[np.ndarray, ...]]:
    """(query row, place, score) of the ``k`` best rows that the cells of each query hold, in strips of bounded size.

    Places are in the order of ids, so they settle ties.
    """
    lens = cells.str.len().to_numpy()
    ends, chosen = np.cumsum(lens), np.concatenate(cells.to_list())
    of = np.repeat(np.arange(len(lens)), lens)
    slots = (np.arange(len(chosen)) - np.repeat(ends - lens, lens)) * wanted
    width = lens.max() * wanted
    for cut in strips(len(lens), width, STRIP):
        mine = slice(ends[cut.start] - lens[cut.start], ends[cut.stop - 1])
        cell, row, slot, q = chosen[mine], of[mine] - cut.start, slots[mine], queries[cut]
        scores, places = np.full((len(q), width), -np.inf), np.zeros((len(q), width), np.int32)
        for c in np.unique(cell):
            here = np.flatnonzero(cell == c)
            dots = np.round(q[row[here]] @ coded[members[c]].T, 12)
            dots[np.isnan(dots)] = -np.inf
            keep = best(dots, wanted)
            n = min(wanted, len(members[c]))
            at = row[here][:, None], slot[here][:, None] + np.arange(n)
            scores[at] = dots[keep].reshape(-1, n)
            places[at] = members[c][np.nonzero(keep)[1]].reshape(-1, n)
        row, at = np.nonzero(best(scores, wanted) & (scores > -np.inf))
        place = places[row, at]
        exact = np.round(np.einsum("nd,nd->n", q[row], vectors[place]), 12)
        row, place, exact = first_k(row, place, exact, k)
        yield row + cut.start, place, exact


def search_bins(
    asked: DataFrame, corpus: DataFrame, k: int, wanted: int, decode: Callable[[Sequence, np.ndarray], np.ndarray]
) -> DataFrame:
    """The ``k`` best rows of every bin among the cells that a query asks there.

    ``asked``: bin, cells, query_id, qv; ``corpus``: bin, cell, id, cv, code. ``decode`` makes vectors of codes and their
    cells: by these the ``wanted`` best of a bin are found, which are then scored by cv.
    """
    kinds = dict(asked.dtypes)
    here = corpus.select(
        "bin", F.lit(0).alias("side"), "id", "cell", "cv", "code",
        *[F.lit(None).cast(kinds[c]).alias(c) for c in ("cells", "qv")],
    )
    there = asked.select("bin", F.lit(1).alias("side"), F.col("query_id").alias("id"), "cells", "qv")
    rows = here.unionByName(there, allowMissingColumns=True)
    placed = rows.repartition("bin").sortWithinPartitions("bin", "side")

    def of_bin(held: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        """Ids, vectors and decoded vectors by id, and the rows of every cell."""
        ids, cells, vectors, coded = (np.concatenate(part) for part in zip(*held))
        by_id = np.argsort(ids, kind="stable")
        cells = cells[by_id]
        return ids[by_id], vectors[by_id], coded[by_id], {c: np.flatnonzero(cells == c) for c in np.unique(cells)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held, at = None, [], None
        for batch in batches:
            if batch.empty:
                continue
            for part in _runs(batch, ("bin", "side")):
                number, side = part[["bin", "side"]].iloc[0]
                if number != now:
                    now, held, at = number, [], None
                if side == 0:
                    cells = part["cell"].to_numpy().astype(np.int64)
                    held.append((part["id"].to_numpy(), cells, unit(part["cv"]), decode(part["code"], cells)))
                    continue
                if at is None:
                    at, held = of_bin(held), []
                ids, vectors, coded, members = at
                names = part["id"].to_numpy()
                for row, place, score in _in_bin(unit(part["qv"]), part["cells"], k, wanted, vectors, coded, members):
                    yield pd.DataFrame({"query_id": names[row], "id": ids[place], "score": score})

    return placed.mapInPandas(run, HITS)


def ask_cells(queries: DataFrame, choose: Callable[[np.ndarray, pd.DataFrame], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]) -> DataFrame:
    """(cell, part, query_id, qv): one row for every part a query asks.

    ``queries``: query_id, qv and what ``choose`` needs. It gets the unit vectors and the rows, and gives
    (row, cell, part) arrays of bounded size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                asks = batch.to_pandas()
                for row, cell, part in choose(unit(asks["qv"]), asks):
                    of = batch.select(["query_id", "qv"]).take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell, pa.int32()), pa.array(part, pa.int32()), *of.columns], ["cell", "part", "query_id", "qv"]
                    )

    return queries.mapInArrow(run, f"cell int, part int, query_id long, qv {dict(queries.dtypes)['qv']}")


def ask_bins(
    queries: DataFrame, choose: Callable[[np.ndarray], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]], bins: Callable[[], np.ndarray]
) -> DataFrame:
    """(bin, cells, query_id, qv): one row for every bin in which a query asks cells, with these.

    ``choose`` gets unit vectors and gives (row, cell, part) arrays of bounded size, all of a row together; ``bins``
    gives the first bin of every cell.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for row, cell, part in choose(unit(batch.column("qv").to_pandas())):
                    number = bins()[cell] + part
                    order = np.lexsort((cell, number, row))
                    row, cell, number = row[order], cell[order], number[order]
                    opens = np.flatnonzero(np.diff(row, prepend=-1) | np.diff(number, prepend=-1))
                    cells = pa.ListArray.from_arrays(pa.array([*opens, len(row)], pa.int32()), pa.array(cell, pa.int32()))
                    of = batch.select(["query_id", "qv"]).take(pa.array(row[opens]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(number[opens], pa.int32()), cells, *of.columns], ["bin", "cells", "query_id", "qv"]
                    )

    return queries.mapInArrow(run, f"bin int, cells array<int>, query_id long, qv {dict(queries.dtypes)['qv']}")


def strips(n: int, width: int, held: int = ASKED_ROWS) -> Iterator[slice]:
    """Rows 0 .. n in slices of about ``held`` / ``width``."""
    step = max(1, held // max(1, width))
    for start in range(0, n, step):
        yield slice(start, min(n, start + step))


def with_parts(row: np.ndarray, cell: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every (row, cell) once for each part of the cell."""
    n = parts[cell]
    ends = np.cumsum(n)
    return np.repeat(row, n), np.repeat(cell, n), np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n)
