"""User interests to profile vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FeedSettings
from ..functions.embedder import Embedder, embed_mean
from ..functions.text import jtrim
from ..functions.vectors import NEAR_ZERO, l2_normalize, norm


def clean_interests(requests: DataFrame, settings: FeedSettings = FeedSettings()) -> DataFrame:
    """Trim the phrases, drop blank ones, and name the ``reason`` of a bad request."""
    trimmed = F.transform(F.coalesce("interests", F.array().cast("array<string>")), jtrim)
    cleaned = requests.withColumn("interests", F.filter(trimmed, lambda x: x != ""))
    return cleaned.withColumn("reason", _count_reason(F.size("interests"), settings))


def _count_reason(n: Column, settings: FeedSettings) -> Column:
    return F.when(n == 0, F.lit("no interests")).when(
        n > settings.max_interests, F.lit("too many interests")
    )


def profile_requests(
    requests: DataFrame, embedder: Embedder, settings: FeedSettings = FeedSettings()
) -> DataFrame:
    """Every request ``(userId, interests, submitted_at)`` with its profile or reason.

    A request is one row of at most ``max_interests`` phrases, so the mean is taken in
    place and nothing is shuffled.
    """
    cleaned = clean_interests(requests, settings)
    usable = F.when(F.col("reason").isNull(), F.col("interests"))
    means = cleaned.withColumn("_mean", embed_mean(usable, embedder))
    near_zero = F.col("reason").isNull() & (norm(F.col("_mean")) < NEAR_ZERO)
    return means.select(
        "userId",
        "submitted_at",
        l2_normalize(F.col("_mean")).alias("profile"),
        F.size("interests").alias("interestCount"),
        F.when(near_zero, F.lit("mean vector is near zero"))
        .otherwise(F.col("reason"))
        .alias("reason"),
    )


def latest_profiles(requests: DataFrame) -> DataFrame:
    """The profile table: per user the newest request that succeeded."""
    good = requests.where(F.col("reason").isNull())
    newest = F.max(F.struct("submitted_at", "interestCount", "profile")).alias("_p")
    return good.groupBy("userId").agg(newest).select(
        "userId",
        F.col("_p.profile").alias("profile"),
        F.col("_p.interestCount").alias("interestCount"),
        F.size("_p.profile").alias("vectorDim"),
    )


# Sums of vectors that a task holds before it passes them on; adding them up takes about
# four times as much, in every task of an executor.
HELD_BYTES = 4 << 20
# Groups of users that are added up together.
PARTS = 1 << 10
_SUMS = "userId string, n bigint, lo int, hi int, total array<double>"


def _add_up(rows: list[pa.RecordBatch], vectors: str, dim: int) -> pa.RecordBatch:
    """One row per user: rows, shortest and longest vector, sum of those of length ``dim``."""
    table = pa.Table.from_batches(rows).combine_chunks()
    users = table.column("userId").combine_chunks().dictionary_encode(null_encoding="encode")
    code = users.indices.to_numpy(zero_copy_only=False)
    size = len(users.dictionary)
    lists = table.column(vectors).combine_chunks()
    length = pc.fill_null(pc.list_value_length(lists), 0)
    whole = pc.equal(length, dim)
    flat = pc.fill_null(pc.list_flatten(lists.filter(whole)).cast(pa.float64()), 0.0)
    at = code[whole.to_numpy(zero_copy_only=False)]
    total = np.zeros((size, dim))
    np.add.at(total, at, flat.to_numpy().reshape(len(at), dim))
    if "n" in table.column_names:
        n, lo, hi = (table.column(c).to_numpy() for c in ("n", "lo", "hi"))
    else:
        n, lo = np.ones(len(code), np.int64), length.to_numpy(zero_copy_only=False)
        hi = lo
    least, most = np.full(size, np.iinfo(np.int32).max), np.full(size, -1)
    np.minimum.at(least, code, lo)
    np.maximum.at(most, code, hi)
    columns = [
        users.dictionary.cast(pa.string()),
        pa.array(np.bincount(code, n, size).astype(np.int64)),
        pa.array(least, pa.int32()),
        pa.array(most, pa.int32()),
        pa.ListArray.from_arrays(pa.array(np.arange(size + 1, dtype=np.int32) * dim), pa.array(total.ravel())),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["userId", "n", "lo", "hi", "total"])


def _partial_sums(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    """Sums of a task's rows by user; a user may have several."""
    most = max(1, HELD_BYTES // (8 * dim))
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for lo in range(0, len(batch), most):
            held.append(_add_up([batch.slice(lo, most)], "embedding", dim))
            if sum(len(h) for h in held) > most:
                held = [_add_up(held, "total", dim)]
                if len(held[0]) > most // 2:
                    yield held.pop()
    if held:
        yield _add_up(held, "total", dim)


def mean_profiles(
    interests: DataFrame, dim: int, settings: FeedSettings = FeedSettings()
) -> DataFrame:
    """Profiles of users whose interest vectors are rows ``(userId, embedding)``.

    Every task adds up its rows per user as matrices, so a user with very many rows is one
    row per task after that. Returns ``profile`` or ``reason`` per user.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _partial_sums(batches, dim)

    def whole(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A user's rows follow each other, so only the last user of a batch may go on in the next.
        held: list[pa.RecordBatch] = []
        names = ["userId", "n", "lo", "hi", "total"]
        for batch in batches:
            if len(batch):
                sums = _add_up([*held, batch.select(names)], "total", dim)
                yield sums.slice(0, len(sums) - 1)
                held = [sums.slice(len(sums) - 1)]
        yield from held

    sums = interests.select("userId", "embedding").mapInArrow(partial, _SUMS)
    # Many users are a group, in order: a call for every user takes longer than adding up.
    sums = sums.withColumn("part", F.pmod(F.xxhash64("userId"), F.lit(PARTS)))
    sums = sums.repartition("part").sortWithinPartitions("part", "userId")
    per_user = sums.groupBy("part").applyInArrow(whole, _SUMS)
    mean = F.transform("total", lambda x: x / F.col("n"))
    means = per_user.select(
        "userId",
        F.col("n").cast("int").alias("interestCount"),
        F.col("lo").alias("_min"),
        F.col("hi").alias("_max"),
        mean.alias("_mean"),
    )
    reason = (
        F.coalesce(
            _count_reason(F.col("interestCount"), settings),
            F.when(
                (F.col("_min") != dim) | (F.col("_max") != dim),
                F.lit("vector dimensions differ"),
            ),
            F.when(norm(F.col("_mean")) < NEAR_ZERO, F.lit("mean vector is near zero")),
        )
    )
    judged = means.withColumn("reason", reason)
    return judged.select(
        "userId",
        F.when(F.col("reason").isNull(), l2_normalize(F.col("_mean"))).alias("profile"),
        "interestCount",
        F.when(F.col("reason").isNull(), F.lit(dim)).alias("vectorDim"),
        "reason",
    )


def good_profiles(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("reason").isNull()).drop("reason")


def interests_response(judged: DataFrame) -> DataFrame:
    """What a user is told about a profile: ``(userId, interestCount, vectorDim, message)``."""
    return judged.select(
        "userId",
        "interestCount",
        F.size("profile").alias("vectorDim"),
        F.coalesce("reason", F.lit("profile created")).alias("message"),
    )
