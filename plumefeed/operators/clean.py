"""Feature records to clean posts.

Every step works on batch and streaming frames alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import FEATURE_COLUMNS, FIELD_SEP, LIST_SEP, POSITION
from ..functions.text import jtrim, split_list, units
from ..functions.wordpiece import decoder, shared_vocab
from ..schemas import CLEAN_POST

MIN_TEXT_UNITS = 3
DEL = "\x7f"


def parse_lines(lines: DataFrame) -> DataFrame:
    """Parse ``line`` into typed fields plus ``reason``, NULL for a good record.

    The first rule that fails names the reason. Columns past the twentieth are ignored;
    an unreadable follower count becomes 0.
    """
    cols = F.col("_cols")
    field = lambda name: F.get(cols, F.lit(POSITION[name]))
    blank = lambda c: F.coalesce(jtrim(c), F.lit("")) == ""
    # Trimming takes separators off both ends, so no item of this split is empty; the
    # cast ignores the same blanks around a number, and DEL besides.
    items = F.split(jtrim(field("text_tokens")), f"{LIST_SEP}+")
    number = lambda name, kind: F.when(
        ~F.contains(field(name), F.lit(DEL)), field(name).try_cast(kind)
    )
    fields = lines.withColumn("_cols", F.split("line", FIELD_SEP, -1)).select(
        *lines.columns,
        "_cols",
        jtrim(field("tweet_id")).alias("tweetId"),
        items.try_cast("array<int>").alias("textTokens"),
        split_list(field("hashtags")).alias("hashtags"),
        split_list(field("present_media")).alias("presentMedia"),
        jtrim(field("tweet_type")).alias("tweetType"),
        jtrim(field("language")).alias("language"),
        number("tweet_timestamp", "bigint").alias("tweetTimestamp"),
        jtrim(field("engaged_with_user_id")).alias("authorId"),
        F.coalesce(
            number("engaged_with_user_follower_count", "bigint"),
            F.lit(0).cast("bigint"),
        ).alias("authorFollowerCount"),
    )
    c = F.col
    reason = (
        F.when(blank(c("line")), F.lit("blank line"))
        .when(F.size(cols) < len(FEATURE_COLUMNS), F.lit("too few columns"))
        .when(c("tweetId") == "", F.lit("blank tweet_id"))
        .when(blank(field("text_tokens")), F.lit("blank text_tokens"))
        .when(
            F.contains(field("text_tokens"), F.lit(DEL))
            | F.exists("textTokens", lambda x: x.isNull()),
            F.lit("token is not a number"),
        )
        .when(F.size("textTokens") == 0, F.lit("no tokens"))
        .when(c("language") == "", F.lit("blank language"))
        .when(c("tweetTimestamp").isNull(), F.lit("tweet_timestamp is not a number"))
        .when(c("tweetTimestamp") <= 0, F.lit("tweet_timestamp is not positive"))
    )
    return fields.withColumn("reason", reason).drop("_cols")


def clean_lines(lines: DataFrame, vocab: DataFrame) -> DataFrame:
    """The clean-post columns of every ``line``, with ``line`` and ``reason``.

    Decoding runs in place with a shared vocabulary, in batches and streams alike.
    """
    parsed = parse_lines(lines)
    good = F.when(F.col("reason").isNull(), F.col("textTokens"))
    decoded = parsed.withColumn("text", decoder(lines.sparkSession, shared_vocab(vocab))(good))
    short = F.col("reason").isNull() & (units(F.col("text")) < MIN_TEXT_UNITS)
    return decoded.withColumn("hasMedia", F.size("presentMedia") > 0).withColumn(
        "reason", F.when(short, F.lit("text too short")).otherwise(F.col("reason"))
    )


def accepted(cleaned: DataFrame) -> DataFrame:
    return cleaned.where(F.col("reason").isNull()).select(*CLEAN_POST.fieldNames())


def rejected(cleaned: DataFrame) -> DataFrame:
    return cleaned.where(F.col("reason").isNotNull()).select("line", "reason")


def count_outcomes(cleaned: DataFrame, name: str = "clean") -> DataFrame:
    """Attach accepted and rejected counts as an observed metric, before any dedup."""
    return cleaned.observe(
        name,
        F.count_if(F.col("reason").isNull()).alias("accepted"),
        F.count_if(F.col("reason").isNotNull()).alias("rejected"),
    )


def to_messages(posts: DataFrame) -> DataFrame:
    """Keyed JSON messages ``(key, value)``; all nine fields are always present."""
    fields = [F.col(n) for n in CLEAN_POST.fieldNames()]
    return posts.select(F.col("tweetId").alias("key"), F.to_json(F.struct(*fields)).alias("value"))
