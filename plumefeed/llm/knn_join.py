"""Exact top-k by inner product as a Voronoi join.

Queries form groups around pivots, data form cells around pivots of their own. Summaries say
everything about groups and cells that the bounds need: of a group how many queries it has
and how far they reach, of a cell how many vectors it has, how far they reach, and the
smallest distances to its pivot. From these follows, for every group, how good its k-th
score is at least, and which cells can reach that. Only vectors of those cells are copied to
a group, and of them only those whose own bound reaches it. Groups are then solved by
themselves, in even shares, and the shares are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..config import materialize
from .vectors import first_copies, matrix, products, scaled, width_of

SCALE = 1024
# Queries of one group, rows of one cell and of one share of it, queries that meet a share.
GROUP_QUERIES, CELL_ROWS, SHARE_ROWS, CHUNK_QUERIES = 128, 2_048, 16_384, 8_192
# Pivots are sent to every task: at most so many, of so many bytes.
MAX_PIVOTS, PIVOT_BYTES = 1_024, 1 << 20


def _pivots(table: DataFrame, rows: int, wanted: int, width: int) -> np.ndarray:
    """Some vectors of a table, picked by a hash of their id."""
    n = max(1, min(wanted, MAX_PIVOTS, PIVOT_BYTES // (8 * width)))
    spot = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    some = table.where(spot <= min(1.0, 4.0 * n / rows) + 1e-3)
    found = some.select("vector").orderBy(F.xxhash64("vec_id", F.lit(5))).limit(n).toArrow()
    if not len(found):
        found = table.select("vector").limit(1).toArrow()
    return matrix(found.column("vector"), width)


def _placed(table: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Each vector with its nearest pivot, ``cell``, and the distance to it, ``far``."""
    width, own = pivots.shape[1], (pivots**2).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("vector"), width)
            with np.errstate(over="ignore", invalid="ignore"):
                cell = np.nan_to_num(own - 2 * x @ pivots.T, nan=np.inf).argmin(axis=1)
                far = np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1))
            # A little more than measured, against rounding.
            far = far * (1 + 1e-9) + 1e-6
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell, pa.int32()), pa.array(far)],
                names=["vec_id", "vector", "cell", "far"],
            )

    out = table.select("vec_id", "vector").mapInArrow(run, "vec_id long, vector binary, cell int, far double")
    return materialize(out, "placed")


def _nearest(placed: DataFrame, k: int) -> DataFrame:
    """The ``k`` smallest distances of each cell; tasks pass on no more than that."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, fars = np.empty(0, np.int32), np.empty(0)
        for batch in batches:
            cells = np.concatenate([cells, batch.column("cell").to_numpy()])
            fars = np.concatenate([fars, batch.column("far").to_numpy()])
            order = np.lexsort((fars, cells))
            cells, fars = cells[order], fars[order]
            few = np.arange(len(cells)) - np.searchsorted(cells, cells) < k
            cells, fars = cells[few], fars[few]
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(fars)], names=["cell", "far"])

    some = placed.select("cell", "far").mapInArrow(run, "cell int, far double")
    number = F.row_number().over(W.partitionBy("cell").orderBy("far"))
    return some.withColumn("n", number).where(F.col("n") <= k).select("cell", "far")


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k best scores of one row, ties to smaller ids."""
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= cut)
    else:
        near = np.arange(len(scores))
    # From the smallest id up, the best last: negating a score could overflow.
    return near[np.lexsort((-ids[near], scores[near]))][::-1][:k]


class Bounds:
    """What the summaries of groups and cells say about their inner products."""

    def __init__(self, centre: np.ndarray, reach: np.ndarray, pivots: np.ndarray, radius: np.ndarray):
        self.centre, self.reach = centre, reach
        with np.errstate(over="ignore", invalid="ignore"):
            self.size = np.sqrt((centre**2).sum(axis=1)) + reach
            self.middle = centre @ pivots.T
            self.slack = reach[:, None] * np.sqrt((pivots**2).sum(axis=1))
            self.most = self._above(self.middle + self.slack + self.size[:, None] * radius)
        self.least = np.full(len(centre), -np.inf)

    @staticmethod
    def _above(bound: np.ndarray) -> np.ndarray:
        return np.nan_to_num(bound + 1e-9 * np.abs(bound) + 1e-3, nan=np.inf, posinf=np.inf)

    def learn(self, cells: np.ndarray, distances: np.ndarray, k: int) -> None:
        """Least k-th score of every group, from vectors at known distances to their pivots."""
        if len(cells) < k:
            return
        for i in range(len(self.centre)):
            with np.errstate(over="ignore", invalid="ignore"):
                low = self.middle[i, cells] - self.slack[i, cells] - self.size[i] * distances
                low = np.nan_to_num(low - 1e-9 * np.abs(low) - 1e-3, nan=-np.inf)
            self.least[i] = np.partition(low, len(low) - k)[len(low) - k]

    def needed(self) -> np.ndarray:
        """Whether a group has to see a cell."""
        return self.most >= self.least[:, None]

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Whether a group has to see a vector, by the vector's own bound."""
        with np.errstate(over="ignore", invalid="ignore"):
            bound = x @ self.centre.T + np.sqrt((x**2).sum(axis=1))[:, None] * self.reach
        return self._above(bound) >= self.least


def knn_join(table: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """The ``k`` best inner products of every query row with all other rows.

    Returns ``query_id, rank, vec_id, score``; ties go to the smaller ``vec_id``. ``is_query``
    is a condition on ``vec_id``. Vectors of different lengths meet as if filled up with
    zeros. Rows that repeat an id with the same vector count once; of different vectors
    under one id the smallest counts. Scores are exact; one beyond a long is the closest long
    and ties with others there. See ``scaled`` for rows that take no part; other columns are
    ignored. No query, or nothing but one row, gives an empty result.

    The bounds hold for any data; how much they save depends on how well it clusters.
    """
    spark = table.sparkSession
    data = scaled(table, SCALE).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    data = materialize(data, "vectors")
    queries = materialize(data.where(is_query), "queries")
    rows, n_queries, width = data.count(), queries.count(), width_of(data)
    schema = "query_id long, rank int, vec_id long, score long"
    if not n_queries or rows < 2:
        return spark.createDataFrame([], schema)
    few = materialize(first_copies(data, k + 1), "first-copies")

    centre = _pivots(queries, n_queries, -(-n_queries // GROUP_QUERIES), width)
    groups = _placed(queries, centre)
    pivots = _pivots(few, rows, -(-rows // CELL_ROWS), width)
    cells = _placed(few, pivots)
    # Summaries: a row for each group and each cell, and k + 1 distances of each cell.
    reach, chunks = np.full(len(centre), -np.inf), np.ones(len(centre), np.int64)
    for r in groups.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect():
        reach[r.cell], chunks[r.cell] = r.far, -(-r.n // CHUNK_QUERIES)
    live = np.flatnonzero(reach >= 0)
    radius, shares = np.full(len(pivots), -np.inf), np.ones(len(pivots), np.int64)
    for r in cells.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect():
        radius[r.cell], shares[r.cell] = r.far, -(-r.n // SHARE_ROWS)
    bounds = Bounds(centre[live], reach[live], pivots, radius)
    near = _nearest(cells, k + 1).toArrow()
    # The query itself may be among the k + 1 best, so k others are at least as good.
    bounds.learn(near.column("cell").to_numpy(), near.column("far").to_numpy(), k + 1)
    needed = bounds.needed()
    # Small cells share a bin, large ones have several: a bin is what meets a group at a time.
    counts = np.where(radius >= 0, shares, 0)
    bins, first = _bins(cells, counts)

    def copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Vectors with each group (and chunk of it) that has to see them."""
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            sees = needed[:, cell].T & bounds.rows(matrix(batch.column("vector"), width))
            row, group = np.nonzero(sees)
            times = chunks[live[group]]
            row, group = np.repeat(row, times), np.repeat(group, times)
            chunk = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            ids = batch.column("vec_id").to_numpy()[row].astype(np.uint64)
            spread = (ids * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            own = first[cell[row]] + (spread % shares[cell[row]].astype(np.uint64)).astype(np.int64)
            part = batch.select(["vec_id", "vector"]).take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, *(pa.array(c, pa.int32()) for c in (live[group], chunk, own))],
                names=["vec_id", "vector", "group", "chunk", "bin"],
            )

    key = ["group", "chunk", "bin"]
    kinds = "vec_id long, vector binary, group int, chunk int, bin int"
    # A group is sent to the bins that hold a cell it needs, and to no other.
    meets: list[list[int]] = [[] for _ in centre]
    for i, group in enumerate(live.tolist()):
        meets[group] = sorted({b for j in np.flatnonzero(needed[i] & (counts > 0)) for b in bins[j]})

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = batch.column("cell").to_numpy()
            ids = batch.column("vec_id").to_numpy().astype(np.uint64)
            chunk = (ids * np.uint64(0xD1342543DE82EF95)) >> np.uint64(33)
            chunk = (chunk % chunks[group].astype(np.uint64)).astype(np.int64)
            times = np.array([len(meets[g]) for g in group.tolist()], np.int64)
            row = np.repeat(np.arange(len(group)), times)
            part = batch.select(["vec_id", "vector"]).take(pa.array(row))
            to = [b for g in group.tolist() for b in meets[g]]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, *(pa.array(c, pa.int32()) for c in (group[row], chunk[row], to))],
                names=["vec_id", "vector", *key],
            )

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        x, ids = matrix(left.column("vector"), width), left.column("vec_id").to_numpy()
        q, own = matrix(right.column("vector"), width), right.column("vec_id").to_numpy()
        out = [np.empty((0, 3), np.int64)]
        for a in range(0, len(q) if len(x) else 0, 64):
            for i, line in zip(own[a : a + 64], products(q[a : a + 64], x)):
                other = np.flatnonzero(ids != i)
                best = other[_top(line[other], ids[other], k)]
                out.append(np.stack([np.full(len(best), i), ids[best], line[best]], axis=1))
        flat = np.concatenate(out)
        return pa.table({c: pa.array(flat[:, i]) for i, c in enumerate(("query_id", "vec_id", "score"))})

    parts = (
        cells.mapInArrow(copies, kinds)
        .groupBy(*key)
        .cogroup(groups.mapInArrow(asked, kinds).groupBy(*key))
        .applyInArrow(solve, "query_id long, vec_id long, score long")
    )
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = parts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _bins(cells: DataFrame, shares: np.ndarray) -> tuple[list[list[int]], np.ndarray]:
    """The bins of each cell: shares of its own if it is large, or one that others are in."""
    sizes = {r.cell: r.n for r in cells.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    bins: list[list[int]] = [[] for _ in shares]
    first, last, used = np.zeros(len(shares), np.int64), -1, SHARE_ROWS
    for j, n in enumerate(shares.tolist()):
        if n > 1:
            first[j], last = last + 1, last + n
            used = SHARE_ROWS
        elif n:
            if used + sizes[j] > SHARE_ROWS:
                last, used = last + 1, 0
            used += sizes[j]
            first[j] = last
        bins[j] = list(range(first[j], first[j] + n))
    return bins, first
