"""Clean-post messages to vector points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.embedder import Embedder, embed
from ..functions.ids import point_id
from ..functions.text import strip
from ..schemas import CLEAN_POST


def read_messages(messages: DataFrame) -> DataFrame:
    """Decode JSON ``value`` and flag rows the index must skip.

    A message is skipped when it is not a JSON object, has no id, or has only blank text.
    """
    post = F.from_json("value", CLEAN_POST)
    return messages.withColumn("_post", post).select(
        *messages.columns,
        *[F.col(f"_post.{n}").alias(n) for n in CLEAN_POST.fieldNames()],
        (
            F.coalesce(strip(F.col("_post.text")) != "", F.lit(False))
            & F.coalesce(F.col("_post.tweetId") != "", F.lit(False))
        ).alias("indexable"),
    )


def payload(decoded: DataFrame) -> DataFrame:
    """Indexable rows with the defaults of missing fields filled in and their point id."""
    c, blank, zero = F.col, F.lit(""), F.lit(0).cast("bigint")
    extra = [n for n in decoded.columns if n not in CLEAN_POST.fieldNames() + ["indexable"]]
    return decoded.where("indexable").select(
        point_id(c("tweetId")).alias("point_id"),
        "tweetId",
        "text",
        F.coalesce(c("language"), blank).alias("language"),
        F.coalesce(c("tweetType"), blank).alias("tweetType"),
        F.coalesce(c("tweetTimestamp"), zero).alias("tweetTimestamp"),
        F.coalesce(c("authorId"), blank).alias("authorId"),
        F.coalesce(c("authorFollowerCount"), zero).alias("authorFollowerCount"),
        F.coalesce(c("hashtags"), F.array().cast("array<string>")).alias("hashtags"),
        F.coalesce(c("hasMedia"), F.lit(False)).alias("hasMedia"),
        *[c(n) for n in extra if n not in ("key", "value")],
    )


def to_points(posts: DataFrame, embedder: Embedder) -> DataFrame:
    """Add the vector of the text as it is, not stripped."""
    return posts.withColumn("embedding", embed(F.col("text"), embedder))
