"""Approximate top-k by inverted lists, for answers that need not be exact.

Centres are fitted on a bounded sample; every point goes to the list of its nearest centre.
A user visits the lists of the nearest centres only. How far the points of a list lie from
its centre bounds what an unvisited list could hold, so for every user it is known whether
the answer is exact all the same, and :func:`recall` measures the others against the search
that is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import materialize
from ..functions.embedder import to_matrix, unit_rows
from .knn import ANGLE_SLACK, HITS, KnnSettings, knn, search_blocks

# Groups of users that are compared together.
PARTS = 1 << 12
# Points the centres are fitted on, rounds of fitting, and bytes of all centres.
SAMPLE, ROUNDS, CENTRE_BYTES = 16_384, 8, 16 << 20


def _fit(rows: np.ndarray, lists: int) -> np.ndarray:
    """Unit centres of ``rows``: the first by spread-out choice, then moved to their means."""
    step = max(1, len(rows) // lists)
    centres = rows[::step][:lists].copy()
    for _ in range(ROUNDS):
        near = (rows @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, rows)
        full = np.bincount(near, minlength=len(centres)) > 0
        centres[full] = unit_rows(sums[full])
    return np.unique(centres, axis=0)


@dataclass
class InvertedLists:
    """Points by list and block, and the size, the reach and the blocks of each list."""

    points: DataFrame
    centres: np.ndarray
    sizes: np.ndarray
    reach: np.ndarray
    base: np.ndarray
    blocks: np.ndarray
    dim: int

    @classmethod
    def build(
        cls, points: DataFrame, dim: int, lists: int | None = None, block_points: int = 16_384
    ) -> InvertedLists:
        """Lists over all ``points(point_id, embedding)``; about the square root of their number."""
        points = points.where(F.col("embedding").isNotNull())
        points = points.select(F.col("point_id").cast("string").alias("point_id"), "embedding")
        n = points.count()
        most = max(1, min(CENTRE_BYTES // (8 * dim), SAMPLE // 4))
        lists = max(1, min(most, lists or int(n**0.5)))
        spot = F.pmod(F.xxhash64("point_id"), F.lit(1 << 30))
        some = points.where(spot <= int((1 << 30) * min(1.0, 2 * SAMPLE / max(n, 1))))
        some = some.orderBy(F.xxhash64("point_id")).limit(SAMPLE).select("embedding").toArrow().column(0)
        rows = unit_rows(to_matrix(some, dim)) if len(some) else np.zeros((0, dim))
        centres = _fit(rows, lists) if len(rows) else np.eye(1, dim)

        @F.arrow_udf("struct<list:int,angle:double>")
        def nearest(vectors: pa.Array) -> pa.Array:
            scores = unit_rows(to_matrix(vectors, dim)) @ centres.T
            angle = np.arccos(np.clip(scores.max(axis=1), -1.0, 1.0))
            return pa.StructArray.from_arrays(
                [pa.array(scores.argmax(axis=1), pa.int32()), pa.array(angle)], ["list", "angle"]
            )

        placed = points.withColumn("_at", nearest("embedding"))
        placed = materialize(placed.select("point_id", "embedding", "_at.list", "_at.angle"), "lists")
        sizes, reach = np.zeros(len(centres), np.int64), np.zeros(len(centres))
        for r in placed.groupBy("list").agg(F.count("*").alias("n"), F.max("angle").alias("far")).collect():
            sizes[r["list"]], reach[r["list"]] = r.n, r.far
        # A crowded list falls into several blocks, so that none is one task's work.
        blocks = -(-sizes // block_points)
        base = np.cumsum(blocks) - blocks
        first = F.array(*[F.lit(int(b)) for b in base])
        count = F.array(*[F.lit(int(b)) for b in blocks])
        block = F.get(first, F.col("list")) + F.pmod(F.xxhash64("point_id"), F.get(count, F.col("list")))
        blocked = placed.select(block.cast("int").alias("block"), "list", "point_id", "embedding")
        return cls(blocked, centres, sizes, reach, base, blocks, dim)

    def _ranked(self, profiles: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each profile the lists with points, nearest first, and the best cosine each may hold."""
        full = np.flatnonzero(self.sizes)
        rows = unit_rows(to_matrix(profiles, self.dim))
        for lo in range(0, len(rows), 256):
            angles = np.arccos(np.clip(rows[lo : lo + 256] @ self.centres[full].T, -1.0, 1.0))
            most = np.cos(np.maximum(angles - self.reach[full] - ANGLE_SLACK, 0.0))
            for order, best in zip(angles.argsort(axis=1, kind="stable"), most):
                yield full[order], best[order]

    def probes_for(self, profiles: DataFrame, k: int, target: float = 0.97, users: int = 256) -> int:
        """The fewest probes with which a sample of users finds ``target`` of its exact hits.

        The sample is bounded by ``users`` and chosen by a hash; its exact hits say for every
        number of probes at once what they would have found.
        """
        some = profiles.select("userId", "profile").orderBy(F.xxhash64("userId")).limit(users)
        some = materialize(some, "sample")
        exact = knn(some, self.points, k, self.dim)
        where = exact.join(self.points.select("point_id", "list"), "point_id")
        held = where.groupBy("userId", "list").agg(F.count("*").alias("n")).collect()
        chosen = some.toArrow()
        place = {
            user: {int(number): i for i, number in enumerate(lists)}
            for user, (lists, _) in zip(
                chosen.column("userId").to_pylist(), self._ranked(chosen.column("profile").combine_chunks())
            )
        }
        found = np.zeros(len(self.centres), np.int64)
        for r in held:
            found[place[r.userId][r["list"]]] += r.n
        share = np.cumsum(found) / max(1, found.sum())
        return int(np.searchsorted(share, target)) + 1 if found.sum() else 1

    def search(
        self, profiles: DataFrame, k: int, probes: int, settings: KnnSettings = KnnSettings()
    ) -> tuple[DataFrame, DataFrame]:
        """Approximate hits ``(userId, point_id, cosine)`` of ``profiles(userId, profile)``.

        Each user visits the ``probes`` nearest lists, and more if these hold fewer than ``k``
        points. The second table, ``(userId, exact)``, says whether no unvisited list can hold
        a better point.
        """
        if not self.sizes.sum():
            spark = profiles.sparkSession
            return spark.createDataFrame([], HITS), spark.createDataFrame([], "userId string, exact boolean")
        me = InvertedLists(None, self.centres, self.sizes, self.reach, self.base, self.blocks, self.dim)

        @F.arrow_udf("struct<blocks:array<int>,rest:double>")
        def visit(profile: pa.Array) -> pa.Array:
            blocks, rest = [], []
            for lists, most in me._ranked(profile):
                n = max(probes, int(np.searchsorted(np.cumsum(me.sizes[lists]), k)) + 1)
                own = lists[:n]
                blocks.append(np.concatenate([me.base[i] + np.arange(me.blocks[i]) for i in own.tolist()]))
                rest.append(float(most[n:].max(initial=-2.0)))
            return pa.StructArray.from_arrays(
                [pa.array(blocks, pa.list_(pa.int32())), pa.array(rest)], ["blocks", "rest"]
            )

        asked = profiles.select("userId", "profile", F.lit(0).cast("bigint").alias("floor"), visit("profile").alias("_v"))
        asked = materialize(asked.select("userId", "profile", "floor", "_v.blocks", "_v.rest"), "probes")
        hits = search_blocks(asked.drop("rest"), self.points, k, self.dim, settings)
        hits = materialize(hits, "approximate")
        last = hits.groupBy("userId").agg(F.min("cosine").alias("least"), F.count("*").alias("n"))
        whole = (F.col("rest") < F.col("least")) & (F.col("n") >= k) | (F.col("rest") < -1.5)
        sure = asked.select("userId", "rest").join(last, "userId", "left")
        return hits, sure.select("userId", F.coalesce(whole, F.lit(False)).alias("exact"))


def _packed(hits: DataFrame) -> DataFrame:
    """``userId, ids``: 64-bit hashes of a user's points, a row for each run of its hits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            users = batch.column("userId").dictionary_encode(null_encoding="encode")
            code, ids = users.indices.to_numpy(), batch.column("id").to_numpy()
            order = np.argsort(code, kind="stable")
            ends = np.cumsum(np.bincount(code, minlength=len(users.dictionary)))
            packed = [x.tobytes() for x in np.split(ids[order], ends[:-1])]
            yield pa.RecordBatch.from_arrays(
                [users.dictionary.cast(pa.string()), pa.array(packed, pa.binary())], names=["userId", "ids"]
            )

    return hits.select("userId", F.xxhash64("point_id").alias("id")).mapInArrow(run, "userId string, ids binary")


def _parted(hits: DataFrame) -> DataFrame:
    return _packed(hits).withColumn("part", F.pmod(F.xxhash64("userId"), F.lit(PARTS)))


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """``hits, found, recall``: how many of the exact hits are among the approximate ones.

    Points are told apart by 64-bit hashes; a user's are compared as two lists, not as rows,
    and the lists of many users at once.
    """

    def compare(exact: pa.Table, found: pa.Table) -> pa.Table:
        both = pa.concat_tables([t.select(["userId", "ids"]) for t in (exact, found)]).combine_chunks()
        code = both.column("userId").combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        size = pc.fill_null(pc.binary_length(both.column("ids")), 0).to_numpy() // 8
        user = np.repeat(code, size)
        ids = np.frombuffer(b"".join(both.column("ids").to_pylist()), np.int64)
        mine = np.arange(len(ids)) < size[: len(exact)].sum()
        order = np.lexsort((ids, user))
        user, ids, mine = user[order], ids[order], mine[order]
        new = np.flatnonzero(np.append(True, (user[1:] != user[:-1]) | (ids[1:] != ids[:-1]))[: len(ids)])
        n, seen = (np.add.reduceat(x.astype(np.int64), new) if len(new) else new for x in (mine, ~mine))
        return pa.table({"hits": [int((n * np.maximum(seen, 1)).sum())], "found": [int((n * seen).sum())]})

    each = _parted(exact).groupBy("part").cogroup(_parted(found).groupBy("part"))
    total = each.applyInArrow(compare, "hits long, found long").agg(
        *[F.coalesce(F.sum(c), F.lit(0).cast("long")).alias(c) for c in ("hits", "found")]
    )
    return total.withColumn("recall", F.col("found") / F.col("hits"))
