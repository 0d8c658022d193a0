"""Streaming sources and sinks of the topics.

A topic is either a Kafka topic, when the connector is on the class path, or a folder:
text files of raw records, parquet files of keyed messages. Jobs take the frame, not the
place, so both serve the same code.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.ids import partition_of
from ..schemas import MESSAGE, VERSION

RAW_TOPIC = "posts.raw"
CLEAN_TOPIC = "posts.cleaned"
MAX_OFFSETS = 2000


def kafka_lines(
    spark: SparkSession, servers: str, topic: str = RAW_TOPIC, max_offsets: int = MAX_OFFSETS
) -> DataFrame:
    """Raw records of a Kafka topic as ``line``, from the earliest offset."""
    return _kafka(spark, servers, topic, max_offsets).select(
        F.col("value").cast("string").alias("line")
    )


def kafka_messages(
    spark: SparkSession, servers: str, topic: str = CLEAN_TOPIC, max_offsets: int = MAX_OFFSETS
) -> DataFrame:
    """Keyed messages of a Kafka topic with their offset as ``version``."""
    return _kafka(spark, servers, topic, max_offsets).select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("offset").cast(VERSION).alias("version"),
    )


def _kafka(spark: SparkSession, servers: str, topic: str, max_offsets: int) -> DataFrame:
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", max_offsets)
        .load()
    )


def file_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Raw records of a folder of text files as ``line``; new files are picked up."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path).withColumnRenamed("value", "line")


def file_messages(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Keyed messages of a folder of parquet files; NULL versions where they have none."""
    reader = spark.readStream.schema(MESSAGE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def kafka_sink(
    messages: DataFrame, servers: str, topic: str, checkpoint: str
) -> DataStreamWriter:
    """Append keyed messages to a Kafka topic; the broker partitions by key."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("kafka.linger.ms", 50)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )


def file_sink(frame: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append rows to a folder of parquet files, each row exactly once."""
    return (
        frame.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )


def publish(messages: DataFrame, path: str, partitions: int = 3) -> None:
    """Write a batch of keyed messages to a topic folder, equal keys in one partition.

    Only the partition number is derived; rows are not shuffled by key, so a frequent key
    makes no oversized task. ``version`` tells the order of arrival: a later publishing is
    higher, and within one the rows go in the order of the frame.
    """
    published = F.lit(time.time_ns() // 1000).cast(VERSION) * F.lit(1 << 62).cast(VERSION)
    place = F.monotonically_increasing_id().cast(VERSION)
    tagged = messages.select(
        "key",
        "value",
        (published + place).cast(VERSION).alias("version"),
        partition_of(F.col("key"), partitions).alias("partition"),
    )
    tagged.write.mode("append").partitionBy("partition").parquet(path)
