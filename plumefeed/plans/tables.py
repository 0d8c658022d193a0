"""The engine's inputs, derived by Spark from the test tables.

Nothing is sampled or made up: every row of a table takes part. Remainders of ids only
decide how a row is written down (a quoted date here, a blank id there), so that every
parsing and reject rule meets real rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import small_batches, spread, work_path
from ..constants import SPECIAL_TOKENS
from ..functions.embedder import HashingEmbedder
from ..functions.ids import point_id
from ..functions.text import hashed
from ..functions.wordpiece import encoder, shared_vocab
from ..operators.index import to_points
from ..operators.ingest import feature_line
from ..operators.profile import mean_profiles
from ..schemas import POINT, PROFILE
from ..sources.files import read_vocab

EPOCH = 1704067200  # 2024-01-01T00:00:00Z
MONTH = 2592000
AS_OF = 1706745600  # 2024-02-01T00:00:00Z
DIM = 64
RAW_CODEC = "gzip"
BLANKS = set(" \t\n\x0b\f\r")

_written: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def _once(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """Path of a derived folder, written on first use in this application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = work_path(spark, "derived", str(len(_written)), name)
        write(path)
        _written[key] = path
    return _written[key]


def _files(spark: SparkSession, sf_dir: str) -> int:
    """Files of a derived table: as many as the documents have splits, eight at least."""
    return max(8, table(spark, sf_dir, "documents").rdd.getNumPartitions())


def post_time() -> Column:
    return F.lit(EPOCH) + (F.col("doc_id") * 7919) % MONTH


# --- vocabulary and token ids ---------------------------------------------------------


def _characters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different characters of each batch of texts, but for white space."""
    for batch in batches:
        found = set().union(*(t.as_py() or "" for t in batch.column("text")))
        yield pa.RecordBatch.from_arrays([pa.array(sorted(found - BLANKS), pa.string())], names=["c"])


def vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vocabulary file with every character of the documents as word start and as tail.

    Its size is bounded by the number of Unicode characters, however many documents.
    """

    def write(path: str) -> None:
        small_batches(spark)
        chars = documents(spark, sf_dir).select("text").mapInArrow(_characters, "c string").distinct()
        pieces = chars.select(F.explode(F.array("c", F.concat(F.lit("##"), "c"))).alias("token"))
        special = spark.createDataFrame([(i, t) for i, t in enumerate(SPECIAL_TOKENS)], "n int, token string")
        lines = special.unionByName(pieces.select(F.lit(len(SPECIAL_TOKENS)).alias("n"), "token"))
        lines.orderBy("n", "token").select("token").write.text(path)

    return read_vocab(spark, _once(spark, sf_dir, "vocab", write))


def encode(spark: SparkSession, sf_dir: str):
    """Text to ids over :func:`vocab`, whole texts."""
    return encoder(spark, shared_vocab(vocab(spark, sf_dir)))


# --- raw feature records --------------------------------------------------------------


def _encoded_records(spark: SparkSession, sf_dir: str, docs: DataFrame) -> DataFrame:
    """``doc_id, value``: feature records of all documents, some damaged, some repeated."""
    d = F.col("doc_id")
    every = lambda n: d % n == 0
    ids = encode(spark, sf_dir)(F.col("text")).cast("array<string>")
    broken = F.concat(ids, F.array(F.lit("abc")))
    zero, no = F.lit("0"), F.lit("false")
    fields = {
        "text_tokens": F.when(every(19), broken).otherwise(ids),
        "hashtags": F.array("lang", "source"),
        "tweet_id": F.when(every(17), F.lit("  ")).otherwise(d.cast("string")),
        "present_media": F.when(F.col("n_chars") % 2 == 0, F.array(F.lit("Photo"))),
        "present_links": F.lit(""),
        "present_domains": F.lit(""),
        "tweet_type": F.when(F.col("lang") == "en", "TopLevel").otherwise("Quote"),
        "language": F.when(every(23), F.lit(" ")).otherwise(F.col("lang")),
        "tweet_timestamp": F.when(every(31), F.lit("n/a"))
        .when(every(29), F.lit("-5"))
        .otherwise(post_time().cast("string")),
        "engaged_with_user_id": hashed(F.col("source")),
        "engaged_with_user_follower_count": F.when(every(41), F.lit("x")).otherwise(
            F.col("n_chars").cast("string")
        ),
        "engaged_with_user_following_count": zero,
        "engaged_with_user_is_verified": no,
        "engaged_with_user_account_creation": zero,
        "engaging_user_id": F.lit("reader"),
        "engaging_user_follower_count": zero,
        "engaging_user_following_count": zero,
        "engaging_user_is_verified": no,
        "engaging_user_account_creation": zero,
        "engagee_follows_engager": no,
    }
    rows = docs.select("doc_id", *[c.alias(n) for n, c in fields.items()])
    line = feature_line(rows)
    short = F.regexp_replace(line, "\t[^\t]*$", "")
    lines = rows.select("doc_id", F.when(every(37), short).otherwise(line).alias("line"))
    copies = F.when(every(13), F.array("line", "line")).otherwise(F.array("line"))
    blank = F.when(every(43), F.array(F.lit("   "))).otherwise(F.array().cast("array<string>"))
    return lines.select("doc_id", F.explode(F.concat(copies, blank)).alias("value"))


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records with their documents' ids, stored, because texts are encoded on the way."""

    def write(path: str) -> None:
        rows = _encoded_records(spark, sf_dir, documents(spark, sf_dir))
        rows.write.option("compression", "zstd").parquet(path)

    return spark.read.schema("doc_id long, value string").parquet(_once(spark, sf_dir, "records", write))


def raw_path(spark: SparkSession, sf_dir: str) -> str:
    """Text files of the records, compressed: token ids take five times the space of the text."""

    def write(path: str) -> None:
        # Several files, so that a stream over them takes several micro-batches. Texts are
        # dealt out, if at all: lines are five times as long.
        docs = table(spark, sf_dir, "documents")
        if docs.rdd.getNumPartitions() < (least := max(8, spark.sparkContext.defaultParallelism)):
            docs = docs.repartition(least, "doc_id")
        out = _encoded_records(spark, sf_dir, docs).select("value")
        out.write.option("compression", RAW_CODEC).text(path)

    return _once(spark, sf_dir, "raw", write)


def deliveries(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The records in three deliveries by time, the last one with much that is late."""
    rows = raw_records(spark, sf_dir)
    third = F.floor((post_time() - EPOCH) / (MONTH // 3))
    held = F.col("doc_id") % 47 == 0
    first, second = rows.where((third == 0) & ~held), rows.where(third == 1)
    last = rows.where((third == 2) | (third == 0))
    return [part.select("value") for part in (first, second, last)]


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.text(raw_path(spark, sf_dir)).withColumnRenamed("value", "line")


# --- post export ----------------------------------------------------------------------


def export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as rows of a post export, in the many spellings exports have."""
    d, n = F.col("doc_id"), F.col("n_chars")
    case = lambda m, *values: F.element_at(F.array(*values), (d % m + 1).cast("int"))
    lit = F.lit
    when = F.timestamp_seconds(post_time())
    iso = F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss")
    date = (
        F.when(d % 29 == 0, lit("soon"))
        .when(d % 7 == 0, F.concat(iso, lit("+03:00")))
        .when(d % 5 == 0, F.date_format(when, "yyyy-MM-dd"))
        .otherwise(F.concat(lit('"'), iso, lit('.000Z"')))
    )
    text = n.cast("string")
    return table(spark, sf_dir, "documents").select(
        d.alias("doc_id"),
        F.when(d % 17 == 0, lit("null")).otherwise(d.cast("string")).alias("id"),
        F.when(d % 11 == 0, lit("")).otherwise(F.col("source")).alias("user_posted"),
        F.when(d % 22 == 0, lit("None")).otherwise(F.concat(lit("Name "), "source")).alias("name"),
        F.col("text").alias("description"),
        date.alias("date_posted"),
        case(
            5,
            F.concat(lit('["#'), "lang", lit('","##'), "source", lit('",""]')),
            F.concat("lang", lit(", #"), "source", lit(",,")),
            lit("null"),
            F.concat(lit('"#'), "source", lit('"')),
            F.concat(lit("['"), "lang", lit("', '"), "source", lit("']")),
        ).alias("hashtags"),
        case(3, F.format_number(n, 0), F.concat(text, lit(".9")), F.concat(lit("x"), text)).alias("followers"),
        case(5, lit("1.9e3"), lit("-7.8"), lit(""), lit("12d"), text).alias("following"),
        case(4, lit("TRUE"), lit("no"), lit("1"), lit("Yes")).alias("is_verified"),
        F.concat(lit('["https://example.com/'), d.cast("string"), lit('"]')).alias("external_url"),
        case(3, lit('["p.jpg"]'), lit("null"), lit("[]")).alias("photos"),
        case(2, lit('["v.mp4", null]'), lit("")).alias("videos"),
        case(
            3,
            lit('{"description":null,"post_id":null}'),
            lit('{"description":"x","post_id":"5"}'),
            lit("null"),
        ).alias("quoted_post"),
        case(
            7,
            lit('{"post_id":"9"}'),
            lit('{"a":""}'),
            lit("[]"),
            lit("reply"),
            lit(""),
            lit("{'a': ''}"),
            lit('{"a":""} x}'),
        ).alias("parent_post_details"),
    )


def export_path(spark: SparkSession, sf_dir: str) -> str:
    """CSV files of :func:`export_rows`, in document order across files."""

    def write(path: str) -> None:
        rows = export_rows(spark, sf_dir)
        ordered = rows.repartitionByRange(_files(spark, sf_dir), "doc_id").sortWithinPartitions("doc_id")
        (
            ordered.drop("doc_id")
            .write.option("header", True)
            .option("quoteAll", True)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(path)
        )

    return _once(spark, sf_dir, "export", write)


# --- points, interests, requests ------------------------------------------------------


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean posts of all documents, text taken directly."""
    return documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("tweetId"),
        "text",
        F.col("lang").alias("language"),
        F.lit("TopLevel").alias("tweetType"),
        post_time().alias("tweetTimestamp"),
        hashed(F.col("source")).alias("authorId"),
        F.col("n_chars").alias("authorFollowerCount"),
        F.array("lang", "source").alias("hashtags"),
        F.lit(False).alias("hasMedia"),
    )


def points_path(spark: SparkSession, sf_dir: str) -> str:
    """All posts with their vectors: the given one, else the hashed words of the text.

    Stored, as an index is, because every feed query reads it.
    """

    def write(path: str) -> None:
        vectors = table(spark, sf_dir, "embeddings").select(
            F.col("vec_id").cast("string").alias("tweetId"), "embedding"
        )
        rows = posts(spark, sf_dir).select(point_id(F.col("tweetId")).alias("point_id"), "*")
        given = rows.join(vectors, "tweetId")
        rest = to_points(rows.join(vectors, "tweetId", "left_anti"), HashingEmbedder(DIM))
        both = given.select(*POINT.fieldNames()).unionByName(rest.select(*POINT.fieldNames()))
        both.write.option("compression", "zstd").parquet(path)

    return _once(spark, sf_dir, "points", write)


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(POINT).parquet(points_path(spark, sf_dir))


def interests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An interest vector per event: ``(userId, vec_id, embedding)``.

    What a user does in one kind of event is one profile, so ``userId`` names both.
    """
    vectors = table(spark, sf_dir, "embeddings")
    n = vectors.count()
    done = table(spark, sf_dir, "events")
    return done.select(
        F.concat_ws("/", "user_id", "event_type").alias("userId"),
        (F.col("event_id") % n).alias("vec_id"),
    ).join(vectors.select("vec_id", "embedding"), "vec_id")


def judged_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile table with reject reasons, stored because every feed query reads it."""

    def write(path: str) -> None:
        mean_profiles(interests(spark, sf_dir), DIM).write.parquet(path)

    return spark.read.schema(PROFILE).parquet(_once(spark, sf_dir, "profiles", write))


def interest_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation turn as a request: its sentences are the interests."""
    return spread(table(spark, sf_dir, "conversations"), "conv_id", "turn").select(
        F.col("conv_id").cast("string").alias("userId"),
        F.split("text", r"[.!?\n]+").alias("interests"),
        F.col("turn").alias("submitted_at"),
    )


def feed_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to three requests of every user; limits are NULL, or go from -2 to 102."""
    first = F.min("event_id")
    limit = F.when(first % 7 != 0, (first % 105 - 2).cast("int")).alias("limit")
    asked = table(spark, sf_dir, "events").groupBy(
        F.concat_ws("/", "user_id", "event_type").alias("userId"), (F.col("event_id") % 3).alias("_n")
    )
    return asked.agg(limit).select(F.concat_ws("/", "userId", "_n").alias("requestId"), "userId", "limit")


def list_text(c) -> Column:
    """A list as one string, for results that are compared."""
    return F.array_join(F.array_compact(c), "|")


