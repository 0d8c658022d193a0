"""CSV, feature-record and vocabulary files."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import work_path
from ..constants import FEATURE_COLUMNS, FIELD_SEP, POSITION
from ..schemas import CSV_COLUMNS
from . import csv_ranges
from .rows import first_rows, with_file_position, with_row_index


def local_copy(spark: SparkSession, url: str) -> str:
    """Stream a file from the web into the shared folder; its path there."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    source = hadoop.Path(url)
    target = hadoop.Path(work_path(spark, "downloads", os.urandom(6).hex(), "posts.csv"))
    hadoop.FileUtil.copy(
        source.getFileSystem(conf), source, target.getFileSystem(conf), target, False, conf
    )
    return target.toString()


def read_posts_csv(spark: SparkSession, path: str) -> DataFrame:
    """Post export at a path or web address: all strings, with row positions and row numbers.

    Each file's header names its columns, in any order; columns a file lacks read as NULL.
    Quoted fields may run over several lines and over the splits of a file: a large file is
    read by many tasks. A file with a header only has no rows.
    """
    if path.startswith(("http://", "https://")):
        path = local_copy(spark, path)
    return csv_ranges.read_named(spark, path, list(CSV_COLUMNS))


def read_feature_lines(
    spark: SparkSession, path: str, offset: int = 0, limit: int = 0
) -> DataFrame:
    """Feature records ``(key, value)`` from text files.

    Blank lines and lines with fewer than 20 columns are skipped. ``offset`` counts file
    lines, ``limit`` counts records returned.
    """
    lines = spark.read.text(path)
    fields = F.split("line", FIELD_SEP, -1)
    if offset or limit:
        lines = with_file_position(lines)
        if offset:
            lines = with_row_index(lines).where(F.col("row_index") >= offset)
    lines = lines.withColumnRenamed("value", "line").where(
        (F.col("line") != "") & (F.size(fields) >= len(FEATURE_COLUMNS))
    )
    if offset or limit:
        lines = first_rows(lines, limit)
    return lines.select(
        F.get(fields, F.lit(POSITION["tweet_id"])).alias("key"), F.col("line").alias("value")
    )


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """Vocabulary ``(token_id, token)``: one token per line, the line number is the id."""
    lines = with_row_index(with_file_position(spark.read.text(path)))
    return lines.select(
        F.col("row_index").cast("int").alias("token_id"), F.col("value").alias("token")
    )
