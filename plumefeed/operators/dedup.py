"""One row per post id."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEEN_LIMIT = 1_000_000


def dedup_posts(posts: DataFrame, key: str = "tweetId", order: str = "tweetTimestamp") -> DataFrame:
    """Keep the earliest row per id; equal times are settled by the other columns.

    A plain minimum, so copies of a frequent id already collapse before the shuffle.
    """
    rest = [c for c in posts.columns if c not in (key, order)]
    first = F.min(F.struct(order, *rest)).alias("_first")
    return posts.groupBy(key).agg(first).select(
        *[F.col(c) if c == key else F.col(f"_first.{c}") for c in posts.columns]
    )


def newest(rows: DataFrame, key: str, version: str) -> DataFrame:
    """Keep the row with the highest version per key, combined before the shuffle."""
    rest = [c for c in rows.columns if c not in (key, version)]
    last = F.max(F.struct(version, *rest)).alias("_last")
    return rows.groupBy(key).agg(last).select(
        *[F.col(c) if c == key else F.col(f"_last.{c}") for c in rows.columns]
    )


def drop_repeats_in_task(posts: DataFrame, *key: str) -> DataFrame:
    """Drop rows whose key was already seen by the same task; the first one stays.

    A stateful dedup sends every row to the task that owns its id. This thins out the
    copies of a frequent id before that; it may miss some, so it replaces nothing. Only the
    keys are looked at, the rows stay where they are.
    """

    @F.arrow_udf("boolean")
    def is_new(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        seen: set = set()
        for keys in batches:
            if len(seen) > SEEN_LIMIT:
                seen.clear()
            codes = keys.dictionary_encode()
            _, first = np.unique(codes.indices.to_numpy(zero_copy_only=False), return_index=True)
            values = codes.dictionary.to_pylist()
            new = np.zeros(len(keys), bool)
            new[first[[v not in seen for v in values]]] = True
            seen.update(values)
            yield pa.array(new)

    return posts.where(is_new.asNondeterministic()(F.to_json(F.struct(*key))))


def dedup_stream(posts: DataFrame, mode: str = "exact", delay: str = "10 minutes") -> DataFrame:
    """Streaming dedup by ``tweetId``, first arrival wins.

    ``exact`` never repeats an id and never drops a late post; its state holds every id
    ever seen. ``bounded`` forgets ids once the watermark passes them and drops posts
    later than ``delay``, so its state stays small.
    """
    if mode not in ("exact", "bounded"):
        raise ValueError(f"unknown dedup mode {mode!r}")
    # A late copy must not take the place of one in time, so there the time is part of the key.
    key = ["tweetId"] if mode == "exact" else ["tweetId", "tweetTimestamp"]
    thinned = drop_repeats_in_task(posts, *key)
    if mode == "exact":
        # Without event times: a watermark before this would let late posts go.
        return thinned.dropDuplicates(["tweetId"])
    timed = thinned.withColumn("_event_time", F.timestamp_seconds("tweetTimestamp"))
    kept = timed.withWatermark("_event_time", delay).dropDuplicatesWithinWatermark(["tweetId"])
    return kept.drop("_event_time")
