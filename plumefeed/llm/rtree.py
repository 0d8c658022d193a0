"""Hard negatives by an R-tree, packed by sort-tile-recursive cuts.

A negative of an anchor scores within a window below one of the anchor's positives. Rows are
cut into tiles by label and by the coordinates that vary most; every tile falls into even
shares, and every share is packed into a tree of minimum bounding boxes. A box gives an
interval for the inner product with an anchor, coordinate by coordinate. Two rounds find
each list: the most promising tile of an anchor gives a floor, then only tiles whose box can
beat it are visited. Inside a share a best-first queue opens boxes until none is left that
reaches the k-th score; boxes outside the score windows are never opened.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..config import materialize
from .vectors import EXACT, first_copies, matrix, products, scaled, shares_of, width_of

# Rows of a share, anchors that meet a share in one group, rows of a leaf, children of a box.
SHARE_ROWS, CHUNK_ANCHORS, LEAF, FAN = 16_384, 4_096, 128, 8
# Rows that the cuts of the tiles are fitted on, and bytes of all tiles' boxes.
SAMPLE_ROWS, BOX_BYTES = 8_192, 4 << 20
FOUND = "anchor_id long, goal int, vec_id long, score long"


def _order(keys: np.ndarray, size: int) -> np.ndarray:
    """Rows in sort-tile-recursive order: runs of ``size`` rows are leaves.

    ``keys`` has one column per coordinate, most important first.
    """
    n = len(keys)
    leaves = -(-n // size)
    depth = min(keys.shape[1], max(1, int(np.ceil(np.log2(max(leaves, 2))))))
    slabs = int(np.ceil(leaves ** (1 / depth)))
    order, slab = np.arange(n), np.zeros(n, np.int64)
    run = float(leaves)
    for c in range(depth):
        order = order[np.lexsort((keys[order, c], slab))]
        run = max(1.0, run / slabs)
        first = np.searchsorted(slab, slab)
        slab = slab * (n + 1) + (np.arange(n) - first) // int(np.ceil(run) * size)
        slab = np.unique(slab, return_inverse=True)[1]
    return order


class Tree:
    """Boxes over the rows of one share."""

    def __init__(self, x: np.ndarray, labels: np.ndarray, ids: np.ndarray):
        spread = x.std(axis=0) if len(x) else np.zeros(x.shape[1])
        dims = np.argsort(-spread, kind="stable")
        order = _order(np.column_stack([labels, x[:, dims[:15]]]), LEAF)
        self.x, self.labels, self.ids = x[order], labels[order], ids[order]
        at = np.arange(0, len(x), LEAF)
        low, high = (f.reduceat(self.x, at, axis=0) for f in (np.minimum, np.maximum))
        first, last = (f.reduceat(self.labels, at) for f in (np.minimum, np.maximum))
        self.levels = [(low, high, first, last)]
        while len(low) > 1:
            at = np.arange(0, len(low), FAN)
            low, high = np.minimum.reduceat(low, at, axis=0), np.maximum.reduceat(high, at, axis=0)
            first, last = np.minimum.reduceat(first, at), np.maximum.reduceat(last, at)
            self.levels.append((low, high, first, last))
        self.size = float(np.abs(x).max(initial=0)) * x.shape[1]
        self.opened = 0

    def search(self, q, own, label, same, k, low, high) -> list[list[tuple[int, int]]]:
        """The ``k`` best ``(score, id)`` in each of the windows ``low`` to ``high``, ends included."""
        found: list[list[tuple[int, int]]] = [[] for _ in low]
        bar, top = low.copy(), high.max()
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        plain = self.size * np.abs(q).max(initial=0) < EXACT
        queue, tick = [(-top, 0, len(self.levels), 0)], 0
        while queue:
            best, _, level, node = heapq.heappop(queue)
            # Strictly below every k-th score: nothing behind can matter.
            if -best < bar.min():
                break
            if level == 0:
                self.opened += 1
                rows = slice(node * LEAF, node * LEAF + LEAF)
                scores = self.x[rows] @ q if plain else products(q[None], self.x[rows])[0]
                near = np.flatnonzero((scores >= bar.min()) & (scores <= top))
                if len(near):
                    self._keep(near + rows.start, scores[near], own, label, same, k, high, bar, found)
                continue
            level -= 1
            span = slice(node * FAN, node * FAN + FAN) if level + 1 < len(self.levels) else slice(0, 1)
            lo, hi, first, last = (a[span] for a in self.levels[level])
            ends = interval(lo, hi, up, down)
            fits = (first <= label) & (label <= last) if same else (first != label) | (last != label)
            fits &= ((ends[1][:, None] >= bar) & (ends[0][:, None] <= high)).any(axis=1)
            for i in np.flatnonzero(fits).tolist():
                tick += 1
                heapq.heappush(queue, (-min(ends[1][i], top), tick, level, span.start + i))
        return found

    def _keep(self, rows, scores, own, label, same, k, high, bar, found) -> None:
        """Put rows among the best of their windows, and raise the windows' bars."""
        ids = self.ids[rows]
        fits = (ids != own) & ((self.labels[rows] == label) == same)
        if not fits.any():
            return
        best = sorted((-int(s), i) for s, i in zip(scores[fits].tolist(), ids[fits].tolist()))
        for j, kept in enumerate(found):
            inside = [(-s, i) for s, i in best if bar[j] <= -s <= high[j]][:k]
            if inside:
                kept += inside
                kept.sort(key=lambda p: (-p[0], p[1]))
                del kept[k:]
                if len(kept) == k:
                    bar[j] = kept[-1][0]


def interval(low: np.ndarray, high: np.ndarray, up: np.ndarray, down: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of boxes with ``up + down``, the parts above and below 0.

    A little wider than computed where sums are beyond what doubles hold exactly.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        least, most = low @ up + high @ down, high @ up + low @ down
        size = np.maximum(np.abs(low), np.abs(high)) @ (up - down)
        slop = np.where(size < EXACT, 0.0, 1e-9 * size)
        least, most = least - slop, most + slop
    return np.nan_to_num(least, nan=-np.inf), np.nan_to_num(most, nan=np.inf)


class Tiles:
    """Cuts of labels and of two coordinates, fitted on a sample; every row falls into one tile."""

    def __init__(self, labels: np.ndarray, x: np.ndarray, tiles: int):
        of = lambda values, n: np.unique(
            np.quantile(values, np.arange(1, n) / n, method="higher") if len(values) and n > 1 else []
        )
        spread = x.std(axis=0) if len(x) else np.zeros(x.shape[1])
        self.dims = np.argsort(-spread, kind="stable")[:2]
        slabs = min(16, tiles, max(1, len(np.unique(labels))))
        side = max(1, int((tiles / slabs) ** 0.5))
        self.by_label = of(labels, slabs)
        self.side = side
        self.cuts, self.finer = [], []
        slab = np.searchsorted(self.by_label, labels, "right")
        for s in range(len(self.by_label) + 1):
            a = x[slab == s][:, self.dims]
            cut = of(a[:, 0], side)
            part = np.searchsorted(cut, a[:, 0], "right")
            self.cuts.append(cut)
            self.finer.append(
                [of(a[part == p][:, 1], side) if a.shape[1] > 1 else of([], 1) for p in range(len(cut) + 1)]
            )
        self.count = (len(self.by_label) + 1) * side * side

    def of(self, labels: np.ndarray, x: np.ndarray) -> np.ndarray:
        slab = np.searchsorted(self.by_label, labels, "right")
        out = np.zeros(len(x), np.int64)
        for s in np.unique(slab).tolist():
            rows = np.flatnonzero(slab == s)
            part = np.searchsorted(self.cuts[s], x[rows, self.dims[0]], "right")
            for p in np.unique(part).tolist():
                own = rows[part == p]
                finer = np.searchsorted(self.finer[s][p], x[own, self.dims[-1]], "right")
                out[own] = (s * self.side + p) * self.side + finer
        return out


def _boxes(placed: DataFrame, width: int) -> DataFrame:
    """``tile, n, first, last, low, high`` of every tile: partial boxes of tasks, then merged."""
    schema = "tile int, n long, first long, last long, low binary, high binary"

    def row(tile, n, first, last, low, high):
        return pa.RecordBatch.from_pylist(
            [
                {"tile": tile, "n": n, "first": first, "last": last, "low": low.tobytes(), "high": high.tobytes()}
            ],
            schema=pa.schema(
                [("tile", pa.int32())]
                + [(c, pa.int64()) for c in ("n", "first", "last")]
                + [(c, pa.binary()) for c in ("low", "high")]
            ),
        )

    def part(batches):
        held: dict[int, list] = {}
        for batch in batches:
            tiles, labels = (batch.column(c).to_numpy() for c in ("tile", "label"))
            x = matrix(batch.column("vector"), width)
            for t in np.unique(tiles).tolist():
                own = tiles == t
                new = [own.sum(), labels[own].min(), labels[own].max(), x[own].min(axis=0), x[own].max(axis=0)]
                held[t] = _merged(held[t], new) if t in held else new
        for t, (n, *rest) in held.items():
            yield row(t, int(n), int(rest[0]), int(rest[1]), *rest[2:])

    def whole(table: pa.Table) -> pa.Table:
        done = None
        for r in table.to_pylist():
            new = [r["n"], r["first"], r["last"], np.frombuffer(r["low"]), np.frombuffer(r["high"])]
            done = _merged(done, new) if done else new
        return pa.Table.from_batches([row(table.column("tile")[0].as_py(), *done)])

    return placed.mapInArrow(part, schema).groupBy("tile").applyInArrow(whole, schema)


def _merged(a: list, b: list) -> list:
    return [a[0] + b[0], min(a[1], b[1]), max(a[2], b[2]), np.minimum(a[3], b[3]), np.maximum(a[4], b[4])]


class Index:
    """Rows by tile and share, and the boxes of all tiles (a bounded number of them)."""

    def __init__(self, rows: DataFrame, width: int):
        self.width = width
        total = rows.count()
        spot = F.xxhash64("vec_id", F.lit(11))
        seen = max(1, min(SAMPLE_ROWS, BOX_BYTES // (8 * max(width, 1))))
        sample = rows.orderBy(spot).limit(seen).select("label", "vector").toArrow()
        most = max(1, min(1024, BOX_BYTES // (16 * max(width, 1))))
        tiles = Tiles(
            sample.column("label").to_numpy(),
            matrix(sample.column("vector"), width),
            min(most, -(-total // (SHARE_ROWS // 4))),
        )

        def place(batches):
            for batch in batches:
                of = tiles.of(batch.column("label").to_numpy(), matrix(batch.column("vector"), width))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(of, pa.int32())], names=[*batch.schema.names, "tile"]
                )

        schema = "vec_id long, label long, vector binary, tile int"
        self.rows = materialize(rows.select("vec_id", "label", "vector").mapInArrow(place, schema), "tiles")
        found = _boxes(self.rows, width).orderBy("tile").collect()
        self.tiles = np.array([r.tile for r in found], np.int64)
        self.first, self.last = (np.array([r[c] for r in found], np.int64) for c in ("first", "last"))
        self.low, self.high = (
            np.array([np.frombuffer(r[c]) for r in found]).reshape(len(found), width) for c in ("low", "high")
        )
        self.shares = shares_of({r.tile: r.n for r in found}, SHARE_ROWS)
        counts = F.array(*[F.lit(n) for n in self.shares]) if self.shares else F.array(F.lit(1))
        self.rows = self.rows.withColumn(
            "share", F.pmod(F.xxhash64("vec_id", F.lit(7)), F.get(counts, F.col("tile"))).cast("int")
        )

    def _routes(self, goals: DataFrame, same: bool, first: bool) -> DataFrame:
        """A row for every share an anchor has to visit: its best tile, or all others that matter."""
        tiles, low, high, shares = self.tiles, self.low, self.high, self.shares
        firsts, lasts, width = self.first, self.last, self.width

        def run(batches):
            for batch in batches:
                q, labels = matrix(batch.column("vector"), width), batch.column("label").to_numpy()
                lows, highs = batch.column("low").to_pylist(), batch.column("high").to_pylist()
                row, to, part = [], [], []
                for i, (x, label) in enumerate(zip(q, labels.tolist())):
                    ends = interval(low, high, np.maximum(x, 0), np.minimum(x, 0))
                    fits = (firsts <= label) & (label <= lasts) if same else (firsts != label) | (lasts != label)
                    at, to_ = np.array(lows[i], np.float64), np.array(highs[i], np.float64)
                    fits &= ((ends[1][:, None] >= at) & (ends[0][:, None] <= to_)).any(axis=1)
                    if not fits.any():
                        continue
                    home = int(np.where(fits, ends[1], -np.inf).argmax())
                    if first:
                        visits = [(home, 0)]
                    else:
                        visits = [(t, s) for t in np.flatnonzero(fits).tolist() for s in range(shares[tiles[t]])]
                    for t, s in visits:
                        row.append(i)
                        to.append(int(tiles[t]))
                        part.append(s)
                out = batch.take(pa.array(row, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*out.columns, pa.array(to, pa.int32()), pa.array(part, pa.int32())],
                    names=[*batch.schema.names, "tile", "share"],
                )

        schema = "anchor_id long, label long, vector binary, chunk int, low array<long>, high array<long>"
        return goals.mapInArrow(run, f"{schema}, tile int, share int")

    def _visit(self, goals: DataFrame, same: bool, k: int, first: bool, chunks: int) -> DataFrame:
        width = self.width

        def solve(left: pa.Table, right: pa.Table) -> pa.Table:
            out = []
            if len(left) and len(right):
                tree = Tree(
                    matrix(left.column("vector"), width),
                    left.column("label").to_numpy(),
                    left.column("vec_id").to_numpy(),
                )
                q = matrix(right.column("vector"), width)
                for x, own, label, low, high in zip(
                    q, *(right.column(c).to_pylist() for c in ("anchor_id", "label", "low", "high"))
                ):
                    lists = tree.search(
                        x, own, label, same, k, np.array(low, np.int64), np.array(high, np.int64)
                    )
                    out += [(own, j, i, s) for j, best in enumerate(lists) for s, i in best]
            columns = list(zip(*out)) or [()] * 4
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
            return pa.table(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)],
                names=["anchor_id", "goal", "vec_id", "score"],
            )

        key = ["tile", "share", "chunk"]
        rows = self.rows.where("share = 0") if first else self.rows
        rows = rows.withColumn("chunk", F.explode(F.array(*[F.lit(c) for c in range(chunks)])))
        routes = self._routes(goals, same, first)
        # Shares that nobody visits are not moved.
        wanted = materialize(routes, "routes")
        seen = wanted.select(*key).distinct()
        return (
            rows.join(seen, key, "left_semi")
            .groupBy(*key)
            .cogroup(wanted.groupBy(*key))
            .applyInArrow(solve, FOUND)
        )

    def best(self, goals: DataFrame, same: bool, k: int, chunks: int) -> DataFrame:
        """``anchor_id, goal, vec_id, score, place``: the ``k`` best rows in each window of ``goals``.

        ``goals`` has ``anchor_id, label, vector, chunk`` and the windows ``low`` and ``high``.
        """
        down = W.partitionBy("anchor_id", "goal").orderBy(F.desc("score"), "vec_id")
        near = self._visit(goals, same, k, True, chunks).withColumn("place", F.row_number().over(down))
        floors = near.where(F.col("place") == k).groupBy("anchor_id").agg(
            F.map_from_entries(F.collect_list(F.struct("goal", "score"))).alias("floors")
        )
        floors = materialize(floors, "floors")
        raised = F.transform(
            "low", lambda v, i: F.greatest(v, F.coalesce(F.element_at("floors", i.cast("int")), v))
        )
        goals = goals.join(floors, "anchor_id", "left").withColumn("low", F.coalesce(raised, "low")).drop("floors")
        all_ = self._visit(materialize(goals, "goals"), same, k, False, chunks)
        return all_.withColumn("place", F.row_number().over(down)).where(F.col("place") <= k)


def hard_negatives(
    table: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
    scale: int = 256,
) -> DataFrame:
    """Rows of other labels that score a little below an anchor's positives.

    Returns ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.
    The positives of an anchor are the ``positives`` best other rows of its label; for each,
    the ``negatives`` best rows of other labels with ``window[0] * positive <= 100 * negative
    <= window[1] * positive`` are returned. Scores are inner products of ``floor(scale * x)``,
    ties go to smaller ids; a score beyond a long is the closest long. ``is_anchor`` is a
    condition on ``vec_id``.

    Rows with a null id, a null label, or a vector that is null, empty, or holds null or
    non-finite components take no part. Shorter vectors meet as if filled up with zeros. Of
    rows that repeat an id the one with the smallest label, then vector counts. A positive
    below zero has an empty window, and so nothing is returned for it. An empty table or no
    anchor gives no rows; other columns are ignored.
    """
    spark = table.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = scaled(table, scale, "label").groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("r"))
    rows = materialize(rows.select("vec_id", "r.*"), "vectors")
    anchors = rows.where(is_anchor).select(F.col("vec_id").alias("anchor_id"), "label", "vector")
    count, width = anchors.count(), width_of(rows)
    if not count:
        return spark.createDataFrame([], schema)
    # Of rows with one label and vector only the smallest ids can be among the best.
    index = Index(materialize(first_copies(rows, max(positives, negatives) + 1, "label"), "copies"), width)
    chunks = -(-count // CHUNK_ANCHORS)
    chunk = F.pmod(F.xxhash64("anchor_id", F.lit(3)), F.lit(chunks)).cast("int").alias("chunk")
    ends = [F.array(F.lit(v).cast("long")) for v in (-(1 << 63), (1 << 63) - 1)]
    anchors = materialize(
        anchors.select("anchor_id", "label", "vector", chunk, ends[0].alias("low"), ends[1].alias("high")),
        "anchors",
    )
    good = materialize(index.best(anchors, True, positives, chunks), "positives")
    lists = good.groupBy("anchor_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "score"))), lambda p: p["score"]).alias("s")
    )

    def part(s: Column, percent: int, up: bool) -> Column:
        """``percent`` of a score, rounded up or down, without a product beyond a long."""
        rest = F.pmod(s, F.lit(100))
        whole = F.floor((s.cast("decimal(20,0)") - rest) / 100).cast("long")
        more = F.floor((rest * percent + (99 if up else 0)) / 100).cast("long")
        return whole * percent + more

    goals = anchors.select("anchor_id", "label", "vector", "chunk").join(lists, "anchor_id").select(
        "anchor_id",
        "label",
        "vector",
        "chunk",
        F.transform("s", lambda s: part(s, window[0], True)).alias("low"),
        F.transform("s", lambda s: part(s, window[1], False)).alias("high"),
    )
    bad = index.best(materialize(goals, "windows"), False, negatives, chunks)
    pairs = good.select(
        "anchor_id",
        (F.col("place") - 1).alias("goal"),
        F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return pairs.join(bad, ["anchor_id", "goal"]).select(
        "anchor_id",
        "positive_id",
        F.col("place").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
