"""Vectors of integers: scaling, packing for the shuffle, exact inner products."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# Sums of products below this are exact in double precision.
EXACT = float(1 << 52)
LONG = (1 << 63) - 1
# First byte of a packed vector: all components fit 32 bits, or they are whole doubles.
NARROW, WIDE = 0, 1


def _packed(x: np.ndarray) -> list[bytes]:
    """Rows of one length as bytes."""
    wide = np.abs(x).max(axis=1, initial=0) >= 2**31
    narrow = np.where(wide[:, None], 0, x).astype("<i4")
    return [
        bytes([WIDE]) + x[i].astype("<f8").tobytes() if w else bytes([NARROW]) + narrow[i].tobytes()
        for i, w in enumerate(wide.tolist())
    ]


def scaled(table: DataFrame, scale: int, *keep: str) -> DataFrame:
    """``vec_id``, the columns ``keep`` as longs, and ``vector``: packed ``floor(scale * x)``.

    Vectors that are null, empty, or hold null or non-finite components are left out, and so
    are rows with a null in ``vec_id`` or ``keep``. A component that is no double any more
    once scaled counts as non-finite.
    """
    names = ["vec_id", *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            at = column.offsets.to_numpy().astype(np.int64)
            # Nulls among the components become NaN.
            flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
            with np.errstate(over="ignore", invalid="ignore"):
                flat = np.floor(flat * scale)
            odd = np.zeros(len(flat) + 1, np.int64)
            np.cumsum(~np.isfinite(flat), out=odd[1:])
            size = np.diff(at)
            good = (odd[at[1:]] == odd[at[:-1]]) & (size > 0)
            good &= column.is_valid().to_numpy(zero_copy_only=False)
            vectors = [None] * len(batch)
            for n in np.unique(size[good]).tolist():
                rows = np.flatnonzero(good & (size == n))
                for row, vector in zip(rows.tolist(), _packed(flat[at[rows][:, None] + np.arange(n)])):
                    vectors[row] = vector
            pick = pa.array(np.flatnonzero(good))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(pick) for c in names), pa.array([v for v in vectors if v], pa.binary())],
                names=[*names, "vector"],
            )

    source = table.select(*[F.col(c).cast("long") for c in names], F.col("embedding").cast("array<double>"))
    source = source.dropna(subset=names)
    return source.mapInArrow(run, ", ".join(f"{c} long" for c in names) + ", vector binary")


def width_of(table: DataFrame) -> int:
    """Components of the longest vector of a packed table."""
    one = F.octet_length("vector") - 1
    is_wide = F.expr("substring(vector, 1, 1)") == F.lit(bytes([WIDE]))
    return int(table.agg(F.max(F.when(is_wide, one / 8).otherwise(one / 4))).first()[0] or 0)


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Packed vectors as rows of doubles; shorter ones are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n or not width:
        return np.zeros((n, width))
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(column.buffers()[2], np.uint8)
    if (np.diff(at) == 1 + 4 * width).all():
        rows = raw[at[0] : at[-1]].reshape(n, 1 + 4 * width)
        if not rows[:, 0].any():
            return np.ascontiguousarray(rows[:, 1:]).view("<i4").astype(np.float64)
    out = np.zeros((n, width))
    for row, a, b in zip(out, at[:-1].tolist(), at[1:].tolist()):
        kind = "<f8" if raw[a] == WIDE else "<i4"
        own = np.frombuffer(raw[a + 1 : b].tobytes(), kind)
        row[: len(own)] = own
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers held as doubles, as longs.

    A product beyond a long is the largest or the smallest long; none wraps around.
    """
    width = a.shape[1]
    size_a, size_b = np.abs(a).max(axis=1, initial=0), np.abs(b).max(axis=1, initial=0)
    if size_a.max(initial=0) * size_b.max(initial=0) * width < EXACT:
        return (a @ b.T).astype(np.int64)
    hard = size_a[:, None] * size_b * width >= EXACT
    with np.errstate(over="ignore", invalid="ignore"):
        out = np.where(hard, 0, a @ b.T).astype(np.int64)
    for i, j in zip(*np.nonzero(hard)):
        exact = sum(int(x) * int(y) for x, y in zip(a[i], b[j]))
        out[i, j] = max(-LONG - 1, min(LONG, exact))
    return out


def first_copies(data: DataFrame, keep: int, *same: str) -> DataFrame:
    """The ``keep`` smallest ids of each distinct vector (and values of ``same``).

    With ties going to smaller ids, no more can be among the best ``keep``. Salted, so that a
    vector with a third of all rows is cut in many tasks first.
    """
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(64)).alias("__salt")
    key = [F.xxhash64("vector").alias("__print"), *same, "vector"]
    names = ["__print", *same, "vector"]
    some = W.partitionBy(*names, "__salt").orderBy("vec_id")
    every = W.partitionBy(*names).orderBy("vec_id")
    few = data.select("vec_id", salt, *key).withColumn("__n", F.row_number().over(some))
    few = few.where(F.col("__n") <= keep).withColumn("__n", F.row_number().over(every))
    return few.where(F.col("__n") <= keep).select("vec_id", *same, "vector")


def shares_of(tiles: dict[int, int], rows: int) -> list[int]:
    """Even shares of each tile (0, 1, ...), none with many more than ``rows`` rows."""
    return [max(1, -(-tiles.get(t, 0) // rows)) for t in range(max(tiles, default=-1) + 1)]
