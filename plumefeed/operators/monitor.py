"""Counts that tell how the jobs are doing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import partition_of


def outcome_counts(cleaned: DataFrame) -> DataFrame:
    """Records per outcome; ``accepted`` or the reject reason."""
    outcome = F.coalesce("reason", F.lit("accepted")).alias("outcome")
    return cleaned.groupBy(outcome).agg(F.count("*").alias("records"))


def partition_counts(messages: DataFrame) -> DataFrame:
    """Messages per ``topic`` and ``partition`` of published topics, with topic totals.

    A total has a NULL partition.
    """
    counted = messages.groupBy("topic", "partition").agg(F.count("*").alias("messages"))
    # Roll up the few counts, not the messages.
    return counted.rollup("topic", "partition").agg(F.sum("messages").alias("messages")).where(
        F.col("topic").isNotNull()
    )


def worker_of(partition: Column, partitions: int, workers: int) -> Column:
    """Worker a partition is assigned to: consecutive ranges, the first ones larger."""
    share, extra = divmod(partitions, workers)
    wide = extra * (share + 1)
    late = F.lit(extra) + F.floor((partition - wide) / F.lit(max(share, 1)))
    return F.when(partition < wide, F.floor(partition / F.lit(share + 1))).otherwise(late).cast("int")


def consumer_lag(ends: DataFrame, commits: DataFrame, partitions: int, workers: int) -> DataFrame:
    """Lag per partition: end offset minus committed offset, with the worker in charge.

    ``ends`` is ``(topic, partition, end_offset)``, ``commits`` ``(topic, partition,
    committed)``; a partition without commit lags by all of it.
    """
    keys = ["topic", "partition"]
    committed = F.coalesce("committed", F.lit(0).cast("bigint"))
    return ends.join(commits, keys, "left").select(
        *keys,
        worker_of(F.col("partition"), partitions, workers).alias("worker"),
        "end_offset",
        committed.alias("committed"),
        (F.col("end_offset") - committed).alias("lag"),
    )


def end_offsets(messages: DataFrame, partitions: int = 3) -> DataFrame:
    """End offset per partition of a topic."""
    placed = messages.select("topic", partition_of(F.col("key"), partitions).alias("partition"))
    return placed.groupBy("topic", "partition").agg(F.count("*").alias("end_offset"))


def histogram(rows: DataFrame, label: str) -> DataFrame:
    """Records per label."""
    return rows.groupBy(label).agg(F.count("*").alias("records"))


def feeds_differ(feed: DataFrame, user_a: str, user_b: str, top: int = 5) -> DataFrame:
    """Whether two users' top items differ: one row ``(differ)``."""
    best = feed.where(F.col("userId").isin(user_a, user_b) & (F.col("rank") <= top))
    sides = best.groupBy("tweetId").agg(F.countDistinct("userId").alias("sides"))
    return sides.agg(F.coalesce(F.max(F.col("sides") < 2), F.lit(False)).alias("differ"))
