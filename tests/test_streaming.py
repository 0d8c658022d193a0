import json
import os

from engine_helpers import rows
from pyspark.sql import functions as F
from test_clean import line

from plumefeed.functions.embedder import HashingEmbedder
from plumefeed.operators import clean, dedup, monitor
from plumefeed.sources import streams
from plumefeed.sources.points import PointTable
from plumefeed.streaming import jobs
from plumefeed.streaming.progress import ProgressListener, ProgressLog, progress_frame, run_logged

T0 = 1700000000


def tokens(*ids):
    return "\x01".join(str(i) for i in ids)


def record(tweet_id, ts, *ids):
    return line(tweet_id=tweet_id, tweet_timestamp=str(ts), text_tokens=tokens(2, *(ids or (7, 8)), 3))


def drop(folder, n, *lines):
    """Add a file to a watched folder; times follow the file number."""
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{n:03d}.txt"
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    os.utime(path, (T0 + n, T0 + n))


def run(spark, vocab, base, mode="exact"):
    posts = jobs.clean_stream(streams.file_lines(spark, f"{base}/in", 1), vocab, mode)
    return jobs.run_available(streams.file_sink(posts, f"{base}/out", f"{base}/checkpoint"))


def output(spark, base, *columns):
    return rows(spark.read.parquet(f"{base}/out"), *columns)


def test_stream_equals_batch_and_counts(spark, toy_vocab, tmp_path):
    base = str(tmp_path)
    drop(f"{base}/in", 0, record("a", T0), record("b", T0 + 1, 9, 10), "junk")
    drop(f"{base}/in", 1, record("a", T0), record("c", T0 + 2), record("d", 0))
    drop(f"{base}/in", 2, record("b", T0 + 1, 9, 10), record("e", T0 + 3))
    query = run(spark, toy_vocab, base)
    lines = spark.read.text(f"{base}/in").withColumnRenamed("value", "line")
    batch = dedup.dedup_posts(clean.accepted(clean.clean_lines(lines, toy_vocab)))
    assert output(spark, base) == rows(batch)
    got = progress_frame(spark, query).where("input_rows > 0").orderBy("batch_id").collect()
    assert [(r.input_rows, r.accepted, r.rejected) for r in got] == [(3, 2, 1), (3, 2, 1), (2, 2, 0)]


def test_restart_continues_from_the_checkpoint(spark, toy_vocab, tmp_path):
    base = str(tmp_path)
    drop(f"{base}/in", 0, record("a", T0), record("b", T0))
    run(spark, toy_vocab, base)
    drop(f"{base}/in", 1, record("a", T0), record("c", T0))
    run(spark, toy_vocab, base)
    run(spark, toy_vocab, base)
    assert output(spark, base, "tweetId") == [("a",), ("b",), ("c",)]


def late_world(base):
    """An id repeated two hours later, and a new one far behind the watermark."""
    drop(f"{base}/in", 0, record("a", T0))
    drop(f"{base}/in", 1, record("b", T0 + 7200))
    drop(f"{base}/in", 2, record("c", T0 + 7300))
    drop(f"{base}/in", 3, record("a", T0 + 7400))
    drop(f"{base}/in", 4, record("late", T0 + 60))


def test_exact_mode_keeps_late_posts_and_never_repeats(spark, toy_vocab, tmp_path):
    base = str(tmp_path)
    late_world(base)
    query = run(spark, toy_vocab, base)
    assert output(spark, base, "tweetId") == [("a",), ("b",), ("c",), ("late",)]
    assert sum(r.late_rows for r in progress_frame(spark, query).collect()) == 0


def test_exact_mode_loses_nothing_to_event_time(spark, toy_vocab, tmp_path):
    """Neither if no rule prunes columns, nor by times that no timestamp can hold."""
    base, name = str(tmp_path), "spark.sql.optimizer.excludedRules"
    late_world(base)
    drop(f"{base}/in", 5, record("far", 10**14))
    spark.conf.set(name, "org.apache.spark.sql.catalyst.optimizer.ColumnPruning")
    try:
        run(spark, toy_vocab, base)
    finally:
        spark.conf.unset(name)
    assert output(spark, base, "tweetId") == [("a",), ("b",), ("c",), ("far",), ("late",)]


def test_bounded_mode_forgets_and_drops(spark, toy_vocab, tmp_path):
    base = str(tmp_path)
    late_world(base)
    query = run(spark, toy_vocab, base, "bounded")
    assert output(spark, base, "tweetId") == [("a",), ("a",), ("b",), ("c",)]
    reported = progress_frame(spark, query).collect()
    assert sum(r.late_rows for r in reported) == 1
    assert max(r.state_rows for r in reported) < 4


def test_copies_are_thinned_before_the_shuffle(spark):
    df = spark.createDataFrame(
        [("hot", 5, i) for i in range(500)] + [("b", 1, 0), ("b", 2, 0)],
        "tweetId string, tweetTimestamp long, n int",
    ).coalesce(1)
    assert rows(dedup.drop_repeats_in_task(df, "tweetId")) == [("b", 1, 0), ("hot", 5, 0)]
    both = dedup.drop_repeats_in_task(df, "tweetId", "tweetTimestamp")
    assert rows(both) == [("b", 1, 0), ("b", 2, 0), ("hot", 5, 0)]


def test_a_late_copy_does_not_hide_one_in_time(spark, toy_vocab, tmp_path):
    base = str(tmp_path)
    drop(f"{base}/in", 0, record("a", T0 + 7200))
    drop(f"{base}/in", 1, record("b", T0 + 7300))
    drop(f"{base}/in", 2, record("x", T0), record("x", T0 + 7400))
    run(spark, toy_vocab, base, "bounded")
    assert output(spark, base, "tweetId", "tweetTimestamp")[-1] == ("x", T0 + 7400)


def test_index_stream_replays_safely(spark, tmp_path):
    base = str(tmp_path)
    table = PointTable(spark, f"{base}/points", 8)
    value = lambda i, text: json.dumps({"tweetId": i, "text": text})
    publish = lambda *items: streams.publish(
        spark.createDataFrame(items, "key string, value string"), f"{base}/topic"
    )
    counts = []
    go = lambda checkpoint: jobs.run_available(
        jobs.index_stream(
            streams.file_messages(spark, f"{base}/topic"), table, HashingEmbedder(8), checkpoint, counts.append
        )
    )
    publish(("a", value("a", "one")), ("b", value("b", "two")), ("x", "{broken"))
    go(f"{base}/cp")
    assert counts == [{"batch_id": 0, "consumed": 3, "upserted": 2, "skipped": 1}]
    publish(("a", value("a", "changed")), ("c", value("c", "three")))
    go(f"{base}/cp")
    assert rows(table.current(), "tweetId", "text") == [("a", "changed"), ("b", "two"), ("c", "three")]
    # Everything again from the start: batches of the same numbers, but of another query.
    newest = rows(table.current(), "tweetId", "text")
    go(f"{base}/cp-new")
    assert rows(table.current(), "tweetId", "text") == newest
    table.compact()
    publish(("d", value("d", "four")), ("b", value("b", "last")))
    go(f"{base}/cp-third")
    newest = [("a", "changed"), ("b", "last"), ("c", "three"), ("d", "four")]
    assert rows(table.current(), "tweetId", "text") == newest
    go(f"{base}/cp")
    assert rows(table.current(), "tweetId", "text") == newest


def test_the_last_of_a_batch_wins_whatever_its_text(spark, tmp_path):
    base = str(tmp_path)
    table = PointTable(spark, f"{base}/points", 8)
    items = [("a", json.dumps({"tweetId": "a", "text": text})) for text in ("zzz first", "mmm", "aaa last")]
    streams.publish(spark.createDataFrame(items, "key string, value string").coalesce(1), f"{base}/topic")
    messages = streams.file_messages(spark, f"{base}/topic")
    jobs.run_available(jobs.index_stream(messages, table, HashingEmbedder(8), f"{base}/cp"))
    assert rows(table.current(), "tweetId", "text") == [("a", "aaa last")]


def test_streams_with_their_own_checkpoints_share_a_table(spark, tmp_path):
    base = str(tmp_path)
    table = PointTable(spark, f"{base}/points", 8)

    def feed(topic, *items):
        rows_ = [(i, json.dumps({"tweetId": i, "text": text})) for i, text in items]
        streams.publish(spark.createDataFrame(rows_, "key string, value string"), f"{base}/{topic}")
        messages = streams.file_messages(spark, f"{base}/{topic}")
        jobs.run_available(jobs.index_stream(messages, table, HashingEmbedder(8), f"{base}/cp-{topic}"))

    feed("one", ("a", "a1"), ("b", "b1"))
    feed("one", ("c", "c1"))
    feed("two", ("d", "d2"), ("b", "b2"))
    expected = [("a", "a1"), ("b", "b2"), ("c", "c1"), ("d", "d2")]
    assert rows(table.current(), "tweetId", "text") == expected
    table.compact()
    assert rows(table.current(), "tweetId", "text") == expected
    feed("three", ("e", "e3"))
    feed("one", ("b", "b4"))
    table.compact()
    table.compact()
    feed("two", ("f", "f2"))
    table.compact()
    expected = [("a", "a1"), ("b", "b4"), ("c", "c1"), ("d", "d2"), ("e", "e3"), ("f", "f2")]
    assert rows(table.current(), "tweetId", "text") == expected
    # Folded commits are gone once no reader of the base before needs them.
    assert len(os.listdir(f"{base}/points/log")) == 1


def test_published_keys_share_a_partition(spark, tmp_path):
    df = spark.range(200).select(
        F.concat(F.lit("k"), (F.col("id") % 20).cast("string")).alias("key"), F.col("id").cast("string").alias("value")
    )
    streams.publish(df, str(tmp_path / "t"), partitions=3)
    stored = spark.read.parquet(str(tmp_path / "t"))
    per_key = stored.groupBy("key").agg(F.countDistinct("partition").alias("n"), F.count("*").alias("rows"))
    assert {(r.n, r.rows) for r in per_key.collect()} == {(1, 10)}


def test_listener_reports_each_batch(spark, toy_vocab, tmp_path):
    seen = []
    listener = ProgressListener(seen.append)
    spark.streams.addListener(listener)
    try:
        base = str(tmp_path)
        drop(f"{base}/in", 0, record("a", T0), "junk")
        run(spark, toy_vocab, base)
        for _ in range(50):
            if seen:
                break
            import time

            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert (0, 2, 1, 1) == (seen[0][0], seen[0][1], seen[0][3], seen[0][4])


def test_monitoring(spark):
    log = spark.createDataFrame([("t", i % 4) for i in range(30)], "topic string, partition int")
    counts = {r.partition: r.messages for r in monitor.partition_counts(log).collect()}
    assert counts == {None: 30, 0: 8, 1: 8, 2: 7, 3: 7}
    ends = spark.createDataFrame([("t", 0, 10), ("t", 1, 5), ("t", 2, 7)], "topic string, partition int, end_offset long")
    commits = spark.createDataFrame([("t", 0, 4), ("t", 1, 5)], "topic string, partition int, committed long")
    lag = monitor.consumer_lag(ends, commits, partitions=3, workers=2)
    assert rows(lag, "partition", "worker", "lag") == [(0, 0, 6), (1, 0, 0), (2, 1, 7)]
    workers = lambda w: [
        r[0] for r in spark.range(5).orderBy("id").select(monitor.worker_of(F.col("id"), 5, w)).collect()
    ]
    assert (workers(2), workers(3), workers(7)) == ([0, 0, 0, 1, 1], [0, 0, 1, 1, 2], [0, 1, 2, 3, 4])


def test_work_is_removed_at_the_end_of_a_job(spark, monkeypatch, tmp_path):
    from plumefeed import config

    monkeypatch.setattr(config, "work_path", lambda spark, *parts: "/".join([str(tmp_path / "job"), *parts]))
    kept = config.materialize(spark.range(3), "numbers")
    assert kept.count() == 3 and os.path.isdir(tmp_path / "job")
    config.drop_work(spark)
    assert not os.path.exists(tmp_path / "job")


def test_progress_of_more_batches_than_spark_keeps(spark, tmp_path):
    n = 104
    for i in range(n):
        drop(f"{tmp_path}/in", i, *[f"line {i}"] * (i % 3 + 1))
    lines = streams.file_lines(spark, f"{tmp_path}/in", 1)
    runs = []

    def start():
        sink = lines.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/checkpoint")
        runs.append(jobs.run_available(sink))
        return runs[-1]

    batches = run_logged(spark, f"{tmp_path}/log", start)
    assert len(runs[0].recentProgress) < n
    got = {r.batch_id: r.input_rows for r in batches.collect()}
    assert got == {i: i % 3 + 1 for i in range(n)}


def test_progress_of_queries_is_told_apart(spark, tmp_path):
    log = ProgressLog(spark, f"{tmp_path}/log", flush_every=2)
    spark.streams.addListener(log)
    try:
        for name, sizes in (("a", [1, 2, 3]), ("b", [4])):
            for i, size in enumerate(sizes):
                drop(f"{tmp_path}/{name}", i, *["x"] * size)
            lines = streams.file_lines(spark, f"{tmp_path}/{name}", 1)
            sink = lines.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/c-{name}")
            query = jobs.run_available(sink)
            assert rows(log.batches(query).where("input_rows > 0"), "input_rows") == [(s,) for s in sizes]
    finally:
        spark.streams.removeListener(log)
