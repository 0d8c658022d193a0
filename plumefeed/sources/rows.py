"""Row numbers in file order, without sorting the rows or moving them to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

TAGS = ["_file", "_start", "_pos"]


def with_file_position(df: DataFrame) -> DataFrame:
    """Tag a freshly scanned frame with its input split and position.

    Call it before anything else, on a frame that comes straight from ``spark.read``.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_pos"),
    )


def _split_bounds(df: DataFrame) -> DataFrame:
    """Per input split: rows, first position, and rows in all earlier splits.

    One line per split, so it is broadcast: the driver holds the list of splits anyway to
    plan the scan. The running sum is the only step in one task.
    """
    splits = df.groupBy("_file", "_start").agg(
        F.count("*").alias("_rows"), F.min("_pos").alias("_first")
    )
    earlier = W.orderBy("_file", "_start").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    return F.broadcast(splits.withColumn("_before", before))


def with_row_index(df: DataFrame, name: str = "row_index") -> DataFrame:
    """Add each row's 0-based index, files in path order.

    ``df`` must come from :func:`with_file_position` with no row dropped, so the rows of
    a split have consecutive positions and the index follows by subtraction. A frame that
    has the index already is returned as it is.
    """
    if name in df.columns:
        return df
    return (
        df.join(_split_bounds(df), ["_file", "_start"])
        .withColumn(name, F.col("_before") + F.col("_pos") - F.col("_first"))
        .drop("_rows", "_first", "_before")
    )


def first_rows(df: DataFrame, limit: int = 0) -> DataFrame:
    """The first ``limit`` rows in file order (0 means all), position tags dropped.

    Splits that lie wholly before the cut pass unranked; only the one split the cut falls
    into is ranked.
    """
    if not limit:
        return df.drop(*TAGS)
    tagged = df.join(_split_bounds(df), ["_file", "_start"]).where(F.col("_before") < limit)
    inside = F.col("_before") + F.col("_rows") <= limit
    in_split = W.partitionBy("_file", "_start").orderBy("_pos")
    cut = (
        tagged.where(~inside)
        .withColumn("_rank", F.row_number().over(in_split))
        .where(F.col("_before") + F.col("_rank") <= limit)
        .drop("_rank")
    )
    return tagged.where(inside).unionByName(cut).drop(*TAGS, "_rows", "_first", "_before")
