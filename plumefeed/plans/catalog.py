"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FeedSettings, materialize, work_path
from ..constants import FEATURE_COLUMNS
from ..functions import text as t
from ..functions.embedder import HashingEmbedder, embed
from ..functions.ids import point_id
from ..functions.ranking import final_score, normalize_similarity, recency_score
from ..functions.vectors import cosine
from ..functions.wordpiece import decode_by_join, decoder, shared_vocab
from ..operators import clean, dedup, feed, index, ingest, ivf, monitor, profile, similar
from ..operators.knn import KnnSettings, knn
from ..schemas import POINT
from ..sources import files, streams
from ..sources.points import PointTable
from ..sources.rows import with_row_index
from ..streaming import jobs
from ..streaming.progress import run_logged
from ..streaming.topk import TopKView, topk_stream
from . import tables as src

EMBEDDER = HashingEmbedder(src.DIM)
CELLS = KnnSettings(way="cells")


def _round(c, digits: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def _scores() -> list[Column]:
    """The three scores at fixed precision; a similarity has at most ten decimals."""
    return [
        _round("semanticSimilarity", 10).alias("semanticSimilarity"),
        _round("recencyScore", 8).alias("recencyScore"),
        _round("finalScore", 8).alias("finalScore"),
    ]


def _flat(df: DataFrame) -> DataFrame:
    """Lists as strings, so that rows compare by value."""
    lists = {f.name for f in df.schema if f.dataType.typeName() == "array"}
    return df.select(
        *[src.list_text(F.col(c)).alias(c) if c in lists else F.col(c) for c in df.columns]
    )


# --- ingest ---------------------------------------------------------------------------


def _adapted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_row_index(files.read_posts_csv(spark, src.export_path(spark, sf_dir)))
    return ingest.adapt_posts(rows, src.encode(spark, sf_dir), src.AS_OF)


def csv_adapt(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = _adapted(spark, sf_dir)
    ids = F.col("text_tokens")
    shown = posts.select(
        F.size(ids).alias("n_tokens"),
        F.md5(F.array_join(ids.cast("array<string>"), ",")).alias("tokens_md5"),
        *[c for c in FEATURE_COLUMNS if c not in ("text_tokens", "present_domains")],
    )
    return _flat(shown)


def csv_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth skipped, at most half taken: offset counts rows, limit counts records."""
    n = src.table(spark, sf_dir, "documents").count()
    rows = files.read_posts_csv(spark, src.export_path(spark, sf_dir))
    encode = src.encode(spark, sf_dir)
    records = ingest.ingest_csv(rows, encode, src.AS_OF, offset=n // 10, limit=n // 2)
    return records.select(F.col("key").alias("tweet_id"))


def tsv_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = _adapted(spark, sf_dir)
    line = ingest.feature_line(posts)
    return posts.select(
        "tweet_id", F.size(F.split(line, "\t", -1)).alias("n_columns"), F.md5(line).alias("line_md5")
    )


def tsv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = files.read_feature_lines(spark, src.raw_path(spark, sf_dir))
    return records.groupBy("key").agg(F.count("*").alias("records"))


def list_field_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags, links = t.parse_list(F.col("hashtags")), t.parse_list(F.col("external_url"))
    return src.export_rows(spark, sf_dir).select(
        "doc_id",
        F.size(tags).alias("n_hashtags"),
        src.list_text(tags).alias("hashtags"),
        src.list_text(links).alias("links"),
        src.list_text(t.media_types(F.col("photos"), F.col("videos"))).alias("media"),
    )


def int_bool_ts_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.export_rows(spark, sf_dir).select(
        "doc_id",
        t.parse_int(F.col("followers")).alias("followers"),
        t.parse_int(F.col("following")).alias("following"),
        t.parse_bool(F.col("is_verified")).alias("verified"),
        t.parse_timestamp(F.col("date_posted"), src.AS_OF).alias("ts"),
    )


def tweet_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = t.tweet_type(F.col("parent_post_details"), F.col("quoted_post"))
    return src.export_rows(spark, sf_dir).select("doc_id", kind.alias("tweet_type"))


def encode_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = src.encode(spark, sf_dir)(F.col("text"))
    docs = src.documents(spark, sf_dir).select("doc_id", ids.alias("ids"))
    return docs.select(
        "doc_id",
        F.size("ids").alias("n_tokens"),
        F.md5(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_md5"),
    )


def decode_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = shared_vocab(src.vocab(spark, sf_dir))
    ids = src.encode(spark, sf_dir)(F.col("text"))
    docs = src.documents(spark, sf_dir).select("doc_id", ids.alias("ids"))
    return docs.select("doc_id", decoder(spark, tokens)(F.col("ids")).alias("text"))


def decode_tokens_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoding by a join with the vocabulary."""
    ids = src.encode(spark, sf_dir)(F.col("text"))
    docs = src.documents(spark, sf_dir).select("doc_id", ids.alias("ids"))
    return decode_by_join(docs, "doc_id", "ids", src.vocab(spark, sf_dir))


def vocab_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.vocab(spark, sf_dir)


# --- clean ----------------------------------------------------------------------------


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_lines(src.raw_lines(spark, sf_dir), src.vocab(spark, sf_dir))


def tsv_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = clean.parse_lines(src.raw_lines(spark, sf_dir)).where(F.col("reason").isNull())
    ids = F.col("textTokens")
    return _flat(
        parsed.select(
            "tweetId",
            F.size(ids).alias("n_tokens"),
            F.md5(F.array_join(ids.cast("array<string>"), ",")).alias("ids_md5"),
            "hashtags",
            "presentMedia",
            "tweetType",
            "language",
            "tweetTimestamp",
            "authorId",
            "authorFollowerCount",
        )
    )


def clean_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(clean.accepted(_cleaned(spark, sf_dir)))


def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = clean.rejected(_cleaned(spark, sf_dir))
    return rejects.select(F.md5("line").alias("line_md5"), "reason")


def clean_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.to_messages(clean.accepted(_cleaned(spark, sf_dir)))


def clean_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.outcome_counts(_cleaned(spark, sf_dir))


def dedup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(dedup.dedup_posts(clean.accepted(_cleaned(spark, sf_dir))))


def _stream_run(spark: SparkSession, sf_dir: str, mode: str, files_per_trigger: int | None = None):
    """Run the clean stream over the raw files; the finished query and its output folder."""
    base = work_path(spark, "streams", uuid.uuid4().hex)
    lines = streams.file_lines(spark, src.raw_path(spark, sf_dir), files_per_trigger)
    posts = jobs.clean_stream(lines, src.vocab(spark, sf_dir), dedup=mode)
    query = jobs.run_available(streams.file_sink(posts, f"{base}/out", f"{base}/checkpoint"))
    return query, spark.read.schema(posts.schema).parquet(f"{base}/out")


def dedup_stream_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_stream_run(spark, sf_dir, "exact", 4)[1])


def dedup_stream_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries in the order of event time, each a run of the stream.

    The last one also brings the first one again and posts that were held back from it: all
    of them are behind the watermark by then and are dropped.
    """
    base = work_path(spark, "streams", uuid.uuid4().hex)
    vocab = src.vocab(spark, sf_dir)
    for delivery in src.deliveries(spark, sf_dir):
        delivery.write.mode("append").option("compression", src.RAW_CODEC).text(f"{base}/in")
        posts = jobs.clean_stream(streams.file_lines(spark, f"{base}/in"), vocab, dedup="bounded")
        jobs.run_available(streams.file_sink(posts, f"{base}/out", f"{base}/checkpoint"))
    return _flat(spark.read.schema(posts.schema).parquet(f"{base}/out"))


def _log(spark: SparkSession) -> str:
    return work_path(spark, "progress", uuid.uuid4().hex)


def progress_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals over all micro-batches of a run."""
    batches = run_logged(spark, _log(spark), lambda: _stream_run(spark, sf_dir, "exact", 4)[0])
    totals = ["input_rows", "accepted", "rejected", "late_rows"]
    return batches.agg(*[F.sum(c).alias(c) for c in totals])


def rate_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replay with a cap on the files of a micro-batch: rows of all batches together."""
    base = work_path(spark, "streams", uuid.uuid4().hex)
    lines = streams.file_lines(spark, src.raw_path(spark, sf_dir), files_per_trigger=4)
    sink = streams.file_sink(lines, f"{base}/out", f"{base}/checkpoint")
    batches = run_logged(spark, _log(spark), lambda: jobs.run_available(sink))
    return batches.agg(F.sum("input_rows").alias("input_rows"))


# --- index ----------------------------------------------------------------------------


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean-post messages of all documents among messages that are no posts."""
    docs = clean.to_messages(src.posts(spark, sf_dir)).withColumn("kind", F.lit("post"))
    events = src.table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("key"), F.col("props").alias("value"), F.lit("event").alias("kind")
    )
    turns = src.table(spark, sf_dir, "conversations").select(
        F.concat_ws("/", "conv_id", "turn").alias("key"), F.col("text").alias("value"), F.lit("turn").alias("kind")
    )
    return docs.unionByName(events).unionByName(turns)


def index_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.read_messages(_messages(spark, sf_dir)).select("kind", "key", "indexable")


def index_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = index.read_messages(_messages(spark, sf_dir))
    return decoded.groupBy("kind").agg(
        F.count("*").alias("consumed"),
        F.count_if("indexable").alias("upserted"),
        F.count_if(~F.col("indexable")).alias("skipped"),
    )


def index_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(index.payload(index.read_messages(_messages(spark, sf_dir)))).drop("kind")


def point_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.posts(spark, sf_dir).select("tweetId", point_id(F.col("tweetId")).alias("point_id"))


def _conversation_table(spark: SparkSession, sf_dir: str) -> PointTable:
    """A vector table written in three batches, conversations as keys, turns as versions.

    System turns, user turns, assistant turns, then the assistant batch again.
    """
    turns = src.table(spark, sf_dir, "conversations")
    found = PointTable(spark, work_path(spark, "points", uuid.uuid4().hex), src.DIM)
    for number, role in [(0, "system"), (1, "user"), (2, "assistant"), (2, "assistant")]:
        messages = turns.where(F.col("role") == role).select(
            F.to_json(F.struct(F.col("conv_id").cast("string").alias("tweetId"), "text")).alias("value"),
            F.col("turn").alias("version"),
        )
        rows = index.to_points(index.payload(index.read_messages(messages)), EMBEDDER)
        found.upsert(rows, number, version="version")
    return found


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _conversation_table(spark, sf_dir)
    found.compact()
    return found.current().select("tweetId", "point_id", "text", "tweetTimestamp", "language")


def upsert_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User and assistant turns as two topics, indexed by streams of their own.

    The table is compacted in between; then the first topic gets all system turns.
    """
    turns = src.table(spark, sf_dir, "conversations")
    base = work_path(spark, "points", uuid.uuid4().hex)
    found = PointTable(spark, f"{base}/table", src.DIM)

    def feed_topic(role: str, rows: DataFrame) -> None:
        value = F.to_json(F.struct(F.col("conv_id").cast("string").alias("tweetId"), "text"))
        ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn")
        messages = ordered.select(F.col("conv_id").cast("string").alias("key"), value.alias("value"))
        streams.publish(messages, f"{base}/{role}")
        topic = streams.file_messages(spark, f"{base}/{role}")
        jobs.run_available(jobs.index_stream(topic, found, EMBEDDER, f"{base}/checkpoint-{role}"))

    feed_topic("user", turns.where("role = 'user'"))
    feed_topic("assistant", turns.where("role = 'assistant'"))
    found.compact()
    feed_topic("user", turns.where("role = 'system'"))
    return found.current().select("tweetId", "point_id", "text")


def index_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conversation_table(spark, sf_dir).profile()


def index_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean posts published to a topic folder, indexed by the streaming job."""
    base = work_path(spark, "streams", uuid.uuid4().hex)
    streams.publish(clean.to_messages(src.posts(spark, sf_dir)), f"{base}/topic")
    found = PointTable(spark, f"{base}/points", src.DIM)
    messages = streams.file_messages(spark, f"{base}/topic", files_per_trigger=2)
    jobs.run_available(jobs.index_stream(messages, found, EMBEDDER, f"{base}/checkpoint"))
    return _flat(found.current().drop("embedding"))


def embed_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = src.documents(spark, sf_dir)
    vectors = docs.select("doc_id", F.posexplode(embed(F.col("text"), EMBEDDER)).alias("component", "x"))
    return vectors.where("x <> 0").select("doc_id", "component", _round(F.col("x").cast("double")).alias("weight"))


# --- profiles -------------------------------------------------------------------------


def interest_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = profile.clean_interests(src.interest_requests(spark, sf_dir))
    return _flat(cleaned.select("userId", "submitted_at", "interests", "reason"))


def _components(profiles: DataFrame) -> DataFrame:
    return profiles.select(
        "userId", "interestCount", "vectorDim", F.posexplode("profile").alias("component", "x")
    ).select("userId", "interestCount", "vectorDim", "component", _round(F.col("x").cast("double"), 5).alias("weight"))


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _components(profile.good_profiles(src.judged_profiles(spark, sf_dir)))


def profile_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as an interest: users with more than 50 are turned away."""
    vectors = src.table(spark, sf_dir, "embeddings")
    n = vectors.count()
    rows = src.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("userId"), (F.col("event_id") % n).alias("vec_id")
    ).join(vectors.select("vec_id", "embedding"), "vec_id")
    judged = profile.mean_profiles(rows, src.DIM)
    return profile.interests_response(judged).select(
        "userId", "interestCount", F.coalesce("vectorDim", F.lit(0)).alias("vectorDim"), "message"
    )


def profile_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth interest has a component less: profiles with one are turned away."""
    short = F.when(F.col("vec_id") % 5 == 0, F.slice("embedding", 1, src.DIM - 1))
    rows = src.interests(spark, sf_dir).withColumn("embedding", F.coalesce(short, "embedding"))
    judged = profile.mean_profiles(rows, src.DIM)
    return profile.interests_response(judged).select("userId", "interestCount", "message")


def interest_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well each interest vector fits the profile it became part of."""
    good = profile.good_profiles(src.judged_profiles(spark, sf_dir))
    rows = src.interests(spark, sf_dir).join(good, "userId")
    fit = cosine(F.col("embedding"), F.col("profile"))
    return rows.select("userId", "vec_id", _round(fit).alias("cosine"))


def _hashed_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = profile.profile_requests(src.interest_requests(spark, sf_dir), EMBEDDER)
    return profile.latest_profiles(judged)


def profiles_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _components(_hashed_profiles(spark, sf_dir)).where("weight <> 0")


def profile_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = profile.good_profiles(src.judged_profiles(spark, sf_dir))
    return good.agg(F.count("*").alias("profiles"))


# --- feed -----------------------------------------------------------------------------


def _hits(spark: SparkSession, sf_dir: str, search: KnnSettings = CELLS) -> DataFrame:
    users = profile.good_profiles(src.judged_profiles(spark, sf_dir))
    return knn(users, src.points(spark, sf_dir), FeedSettings().pool_size, src.DIM, search)


def knn_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(spark, sf_dir)


def knn_topk_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lists, kept up to date while the points arrive file by file."""
    base = work_path(spark, "topk", uuid.uuid4().hex)
    view = TopKView(spark, f"{base}/view", FeedSettings().pool_size, src.DIM, CELLS, fold_every=2)
    view.set_users(profile.good_profiles(src.judged_profiles(spark, sf_dir)))
    path = src.points_path(spark, sf_dir)
    n = src.points(spark, sf_dir).rdd.getNumPartitions()
    source = spark.readStream.schema(POINT).option("maxFilesPerTrigger", -(-n // 6)).parquet(path)
    jobs.run_available(topk_stream(source, view, f"{base}/checkpoint"))
    return view.current()


def knn_topk_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(spark, sf_dir, CELLS)


def approx_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inverted lists against the exact search, for all users; a sample of them sets the probes."""
    users = profile.good_profiles(src.judged_profiles(spark, sf_dir))
    lists = ivf.InvertedLists.build(src.points(spark, sf_dir), src.DIM)
    k = FeedSettings().pool_size
    found, sure = lists.search(users, k, lists.probes_for(users, k))
    measured = ivf.recall(found, _hits(spark, sf_dir))
    return measured.select(
        F.lit(sure.count()).alias("users"), "hits", (F.col("recall") >= 0.95).alias("reached")
    )


def _scored(spark: SparkSession, sf_dir: str, near: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Scored hits; with ``near``, of :func:`_near`, they have the classes for a walk."""
    users, points = profile.good_profiles(src.judged_profiles(spark, sf_dir)), src.points(spark, sf_dir)
    located, along = feed.with_times(points), ["_times"]
    if near:
        located, along = similar.with_classes(located, *near), ["_times", "_classes"]
    hits = knn(users, located, FeedSettings().pool_size, src.DIM, CELLS, ([], along))
    return feed.score_hits(hits, points, src.AS_OF)


def candidate_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("userId", "position", "point_id", *_scores())


def score_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score formulas over every event, its value standing in for the cosine."""
    ts = F.unix_seconds(F.col("ts").cast("timestamp"))
    cos = F.col("value") / 100 - 1
    return src.table(spark, sf_dir, "events").select(
        "event_id",
        _round(normalize_similarity(cos), 8).alias("similarity"),
        _round(recency_score(ts, src.EPOCH + 864000), 8).alias("recency"),
        _round(final_score(cos, ts, src.EPOCH + 864000), 8).alias("score"),
    )


def content_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.array_sort(t.content_words(F.col("text")))
    return src.documents(spark, sf_dir).select(
        "doc_id", F.size(words).alias("n_words"), F.array_join(words, " ").alias("words")
    )


def jaccard_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word overlap of each conversation turn with the turn before."""
    turns = src.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", t.content_words(F.col("text")).alias("words")
    )
    before = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("words").alias("previous"))
    both = turns.join(before, ["conv_id", "turn"])
    return both.select(
        "conv_id", "turn", _round(t.jaccard(F.col("words"), F.col("previous"))).alias("jaccard")
    )


def _near(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Classes and similar pairs of all posts; finding them runs jobs."""
    return similar.similar_posts(src.points(spark, sf_dir), FeedSettings().near_duplicate_threshold)


def similar_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similar classes by their smallest members, and how many posts each class has."""
    members, pairs = _near(spark, sf_dir)
    heads = members.groupBy("class").agg(F.min("point_id").alias("head"), F.count("*").alias("posts"))
    ends = [heads.select(*[F.col(c).alias(f"{c}_{side}") for c in heads.columns]) for side in "ab"]
    both = pairs.join(ends[0], F.col("a") == F.col("class_a")).join(ends[1], F.col("b") == F.col("class_b"))
    swapped = F.col("head_a") > F.col("head_b")
    return both.select(
        F.least("head_a", "head_b").alias("point_id"),
        F.greatest("head_a", "head_b").alias("other_id"),
        F.when(swapped, F.col("posts_b")).otherwise(F.col("posts_a")).alias("posts"),
        F.when(swapped, F.col("posts_a")).otherwise(F.col("posts_b")).alias("other_posts"),
        _round("jaccard").alias("jaccard"),
    )


def near_dup_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = _near(spark, sf_dir)
    kept = similar.keep_distinct(_scored(spark, sf_dir, near), *near, feed.SCORES)
    return kept.select("userId", "rank", "point_id", _round("finalScore", 8).alias("finalScore"))


def near_dup_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = _near(spark, sf_dir)
    found = similar.match_distinct(_scored(spark, sf_dir, near), *near)
    return found.select("userId", "point_id", "kept_point_id", _round("jaccard").alias("jaccard"))


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.build_feeds(
        src.feed_requests(spark, sf_dir),
        profile.good_profiles(src.judged_profiles(spark, sf_dir)),
        src.points(spark, sf_dir),
        src.AS_OF,
        src.DIM,
        FeedSettings.from_conf(spark),
        near=_near(spark, sf_dir),
    )


def feed_flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _feed(spark, sf_dir)
    return _flat(rows.select(*[c for c in rows.columns if c not in feed.SCORES], *_scores()))


def feed_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds of all conversations over all documents, both embedded from their text."""
    profiles_ = _hashed_profiles(spark, sf_dir)
    posts = src.posts(spark, sf_dir).withColumn("point_id", point_id(F.col("tweetId")))
    # The index is a stored table: every step of the feed reads it.
    points = materialize(index.to_points(posts, EMBEDDER), "hashed-points")
    profiles_ = materialize(profiles_, "hashed-profiles")
    rows = feed.build_feeds(
        profiles_.select(
            F.col("userId").alias("requestId"), "userId", F.lit(None).cast("int").alias("limit")
        ),
        profiles_,
        points,
        src.AS_OF,
        src.DIM,
    )
    return rows.select("userId", "rank", "tweetId", _round("finalScore", 8).alias("finalScore"))


def feed_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = profile.good_profiles(src.judged_profiles(spark, sf_dir))
    served, _ = feed.split_requests(src.feed_requests(spark, sf_dir), good)
    answers = feed.feed_responses(served, _feed(spark, sf_dir))
    items = F.transform("items", lambda i: F.concat_ws(":", i["rank"].cast("string"), i["tweetId"]))
    return answers.select("requestId", "userId", "count", F.array_join(items, ",").alias("items"))


def feed_missing_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer asks for a feed of purchases; without a profile it gets an error row."""
    buyer = F.concat(F.col("c_custkey").cast("string"), F.lit("/purchase"))
    asked = src.table(spark, sf_dir, "customer").select(buyer.alias("userId"))
    good = profile.good_profiles(src.judged_profiles(spark, sf_dir))
    return feed.split_requests(asked, good)[1].select("userId", F.lit("no_profile").alias("status"))


def feed_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = src.feed_requests(spark, sf_dir)
    return asked.select("requestId", F.col("limit").alias("requested"), feed.clamp_limit(F.col("limit")).alias("limit"))


def feed_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(feed.shared_feeds(_feed(spark, sf_dir)))


# --- monitoring -----------------------------------------------------------------------


def partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both topics are published, and the partitions of their folders counted."""
    base = work_path(spark, "topics", uuid.uuid4().hex)
    raw = files.read_feature_lines(spark, src.raw_path(spark, sf_dir))
    cleaned = clean.to_messages(dedup.dedup_posts(clean.accepted(_cleaned(spark, sf_dir))))
    for topic, messages in [(streams.RAW_TOPIC, raw), (streams.CLEAN_TOPIC, cleaned)]:
        streams.publish(messages, f"{base}/topic={topic}")
    counts = monitor.partition_counts(spark.read.parquet(base))
    return counts.select("topic", F.coalesce("partition", F.lit(-1)).alias("partition"), "messages")


def consumer_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log as a topic; everything before the last ten days is committed."""
    log = src.table(spark, sf_dir, "events").select(
        F.lit("events").alias("topic"),
        F.col("user_id").cast("string").alias("key"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("at"),
    )
    done = log.where(F.col("at") < src.EPOCH + 1728000)
    commits = monitor.end_offsets(done).withColumnRenamed("end_offset", "committed")
    return monitor.consumer_lag(monitor.end_offsets(log), commits, partitions=3, workers=2)


def topic_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.histogram(src.table(spark, sf_dir, "embeddings"), "label")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in [
        csv_adapt,
        csv_slice,
        tsv_encode,
        tsv_scan,
        list_field_parse,
        int_bool_ts_parse,
        tweet_type,
        vocab_scan,
        encode_tokens,
        decode_tokens,
        decode_tokens_joined,
        tsv_parse,
        clean_posts,
        reject_reasons,
        clean_json,
        clean_counts,
        dedup_exact,
        dedup_stream_exact,
        dedup_stream_bounded,
        progress_metrics,
        rate_replay,
        index_gate,
        index_counts,
        index_payload,
        point_ids,
        upsert_latest,
        upsert_streams,
        index_profile,
        index_stream,
        embed_hashed,
        interest_clean,
        profiles,
        profile_rejects,
        profile_lengths,
        profiles_hashed,
        profile_count,
        interest_cosine,
        knn_topk,
        knn_topk_cells,
        knn_topk_stream,
        approx_recall,
        candidate_scores,
        score_functions,
        content_words,
        jaccard_turns,
        similar_pairs,
        near_dup_greedy,
        near_dup_matches,
        feed_hashed,
        feed_nested,
        feed_missing_profile,
        feed_limits,
        feed_diff,
        partition_counts,
        consumer_lag,
        topic_histogram,
    ]
} | {"feed": feed_flagship}
