"""Post export rows to feature records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    FALLBACK_ID_PREFIX,
    FEATURE_COLUMNS,
    FIELD_SEP,
    LIST_SEP,
    READER_ID,
    UNKNOWN_AUTHOR,
    UNKNOWN_LANGUAGE,
)
from ..functions import text as t
from ..sources.rows import first_rows, with_row_index

Encode = Callable[[Column], Column]


def has_text() -> Column:
    return t.clean_field(F.col("description")) != ""


def adapt_posts(rows: DataFrame, encode: Encode, ingest_ts: int) -> DataFrame:
    """The 20 feature columns, typed, of every usable export row.

    ``rows`` has the export columns and ``row_index``. Rows without text or tokens go.
    ``encode`` maps text to token ids; ``ingest_ts`` stands in for unreadable dates.
    """
    c = F.col
    blank = lambda x: F.nullif(t.clean_field(x), F.lit(""))
    index = c("row_index").cast("string")
    fallback = F.concat(F.lit(FALLBACK_ID_PREFIX), index, F.lit("-"), c("_text"))
    posts = (
        rows.withColumn("_text", t.clean_field(c("description")))
        .withColumn("text_tokens", encode(c("_text")))
        .where((c("_text") != "") & (F.size("text_tokens") > 0))
    )
    zero = F.lit(0).cast("bigint")
    values = {
        "text_tokens": c("text_tokens"),
        "hashtags": t.parse_list(c("hashtags")),
        "tweet_id": F.coalesce(blank(c("id")), t.hashed(fallback)),
        "present_media": t.media_types(c("photos"), c("videos")),
        "present_links": t.parse_list(c("external_url")),
        "present_domains": F.array().cast("array<string>"),
        "tweet_type": t.tweet_type(c("parent_post_details"), c("quoted_post")),
        "language": F.lit(UNKNOWN_LANGUAGE),
        "tweet_timestamp": t.parse_timestamp(c("date_posted"), ingest_ts),
        "engaged_with_user_id": t.hashed(
            F.coalesce(blank(c("user_posted")), blank(c("name")), F.lit(UNKNOWN_AUTHOR))
        ),
        "engaged_with_user_follower_count": t.parse_int(c("followers")),
        "engaged_with_user_following_count": t.parse_int(c("following")),
        "engaged_with_user_is_verified": t.parse_bool(c("is_verified")),
        "engaged_with_user_account_creation": zero,
        "engaging_user_id": F.lit(READER_ID),
        "engaging_user_follower_count": zero,
        "engaging_user_following_count": zero,
        "engaging_user_is_verified": F.lit(False),
        "engaging_user_account_creation": zero,
        "engagee_follows_engager": F.lit(False),
    }
    carried = [x for x in ("_file", "_start", "_pos", "row_index") if x in rows.columns]
    return posts.select(*[values[n].alias(n) for n in FEATURE_COLUMNS], *carried)


def feature_line(df: DataFrame) -> Column:
    """One tab-separated line of the 20 columns of ``df``; lists joined by 0x01."""
    fields = []
    for name in FEATURE_COLUMNS:
        kind = df.schema[name].dataType.typeName()
        value = F.col(name)
        if kind == "array":
            value = F.array_join(value.cast("array<string>"), LIST_SEP)
        fields.append(F.coalesce(value.cast("string"), F.lit("")))
    return F.concat_ws(FIELD_SEP, *fields)


def ingest_csv(
    rows: DataFrame, encode: Encode, ingest_ts: int, offset: int = 0, limit: int = 0
) -> DataFrame:
    """Export rows to keyed feature records ``(key, value)``.

    ``offset`` skips source rows, ``limit`` counts records that come out; 0 means all.
    Rows without text give no record, so the limit is cut before anything is encoded.
    """
    rows = with_row_index(rows).where(F.col("row_index") >= offset)
    if limit:
        rows = first_rows(rows.where(has_text()), limit)
    posts = adapt_posts(rows, encode, ingest_ts)
    return posts.select(F.col("tweet_id").alias("key"), feature_line(posts).alias("value"))
