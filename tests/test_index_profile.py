import json

import numpy as np
import pyarrow as pa
import pytest
from engine_helpers import rows
from pyspark.sql import functions as F

from plumefeed import FeedSettings
from plumefeed.functions.embedder import HashingEmbedder, embed
from plumefeed.operators import index, profile
from plumefeed.sources.points import PointTable

DIM = 16
EMBEDDER = HashingEmbedder(DIM)


def messages(spark, *values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, version long")


def post(tweet_id, text, **more):
    return json.dumps({"tweetId": tweet_id, "text": text, **more})


def test_gate(spark):
    values = [
        post("a", "good"),
        "{broken",
        "[1]",
        "5",
        post("", "no id"),
        json.dumps({"text": "no id"}),
        post("b", "  \n"),
        json.dumps({"tweetId": "c", "text": None}),
        None,
    ]
    got = index.read_messages(messages(spark, *values)).orderBy("version").collect()
    assert [r.indexable for r in got] == [True] + [False] * 8


def test_payload_defaults(spark):
    decoded = index.read_messages(messages(spark, post("a", "  kept as is ")))
    row = index.payload(decoded).first()
    assert row.text == "  kept as is "
    assert (row.language, row.tweetType, row.authorId) == ("", "", "")
    assert (row.tweetTimestamp, row.authorFollowerCount, row.hashtags, row.hasMedia) == (0, 0, [], False)


def points(spark, *values):
    decoded = index.read_messages(messages(spark, *values))
    return index.to_points(index.payload(decoded), EMBEDDER)


def table(spark, tmp_path, dim=DIM):
    return PointTable(spark, str(tmp_path / "points"), dim)


def test_upsert_is_idempotent_and_last_wins(spark, tmp_path):
    t = table(spark, tmp_path)
    t.ensure()
    assert t.current().count() == 0
    first = points(spark, post("a", "one"), post("b", "two"), post("a", "three"))
    t.upsert(first, 0, "version")
    t.upsert(first, 0, "version")
    t.upsert(first.limit(0), 0, "version", "other")
    assert rows(t.current(), "tweetId", "text") == [("a", "three"), ("b", "two")]
    t.upsert(points(spark, post("b", "changed")), 1, "version")
    expected = [("a", "three"), ("b", "changed")]
    assert rows(t.current(), "tweetId", "text") == expected
    t.compact()
    t.compact()
    assert rows(t.current(), "tweetId", "text") == expected
    t.upsert(points(spark, post("c", "new"), post("a", "last")), 2, "version")
    assert rows(t.current(), "tweetId", "text") == [("a", "last"), ("b", "changed"), ("c", "new")]
    t.compact()
    assert rows(t.profile()) == [(3, DIM, DIM, "cosine")]


def test_upsert_creates_the_table(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(points(spark, post("a", "one")), 0)
    assert t.current().count() == 1


def test_dimensions_are_checked(spark, tmp_path):
    table(spark, tmp_path).ensure()
    with pytest.raises(ValueError):
        table(spark, tmp_path, DIM + 1).ensure()
    wrong = points(spark, post("a", "one")).withColumn("embedding", F.slice("embedding", 1, 3))
    with pytest.raises(Exception, match="vector length 3"):
        table(spark, tmp_path).upsert(wrong, 0)


def test_embedder(spark):
    texts = ["moon over snow", "moon over snow", "", None, "snow"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.v for r in df.select("i", embed(F.col("t"), EMBEDDER).alias("v")).collect()}
    assert got[0] == got[1] and len(got[0]) == DIM
    assert np.linalg.norm(got[0]) == pytest.approx(1.0, abs=1e-6)
    assert np.linalg.norm(got[2]) == 0.0 and got[3] is None
    assert np.dot(got[0], got[4]) > 0


def test_a_model_of_another_dimension_fails(spark):
    class Wrong:
        dim = 4

        def load(self):
            return lambda texts: np.zeros((len(texts), 3), dtype=np.float32)

    with pytest.raises(Exception, match="expected"):
        spark.createDataFrame([("x",)], "t string").select(embed(F.col("t"), Wrong())).collect()


def test_the_model_sees_small_batches_and_loads_once_per_task(spark):
    class Counting:
        dim = 2

        def load(self):
            loaded = []

            def run(texts):
                loaded.append(len(texts))
                return np.array([[len(texts), len(loaded)]] * len(texts), dtype=np.float32)

            return run

    df = spark.range(100, numPartitions=1).select(embed(F.col("id").cast("string"), Counting()).alias("v"))
    assert {tuple(r.v) for r in df.collect()} == {(32, 1), (32, 2), (32, 3), (4, 4)}


def requests(spark, *items):
    return spark.createDataFrame(items, "userId string, interests array<string>, submitted_at long")


def test_interest_rules(spark):
    df = requests(
        spark,
        ("a", [" spark ", "", "  ", "x"], 1),
        ("b", ["", " "], 1),
        ("c", [f"p{i}" for i in range(50)], 1),
        ("d", [f"p{i}" for i in range(51)], 1),
        ("e", None, 1),
    )
    got = {r.userId: r for r in profile.clean_interests(df).collect()}
    assert got["a"].interests == ["spark", "x"]
    assert [got[u].reason for u in "abcde"] == [
        None, "no interests", None, "too many interests", "no interests",
    ]


def fixed():
    """An embedder whose vectors are chosen by the text itself."""

    class Fixed:
        dim = 2

        def load(self):
            known = {"east": [1, 0], "west": [-1, 0], "north": [0, 1]}
            return lambda texts: np.array([known[t] for t in texts], dtype=np.float32).reshape(-1, 2)

    return Fixed()


def test_profiles_from_phrases(spark):
    df = requests(
        spark,
        ("a", ["east", "north"], 1),
        ("b", ["east", "west"], 1),
        ("c", ["east"], 1),
        ("c", ["north"], 2),
        ("c", ["east", "west"], 3),
        ("d", [], 1),
    )
    judged = profile.profile_requests(df, fixed())
    reasons = {(r.userId, r.submitted_at): r.reason for r in judged.collect()}
    assert reasons[("b", 1)] == reasons[("c", 3)] == "mean vector is near zero"
    assert reasons[("d", 1)] == "no interests"
    got = {r.userId: r for r in profile.latest_profiles(judged).collect()}
    assert set(got) == {"a", "c"}
    assert got["a"].profile == pytest.approx([2**-0.5, 2**-0.5])
    assert (got["a"].interestCount, got["a"].vectorDim) == (2, 2)
    # The newest request failed, so the one before it stands.
    assert got["c"].profile == pytest.approx([0.0, 1.0])


def test_profiles_from_vectors(spark):
    df = spark.createDataFrame(
        [("a", [1.0, 0.0]), ("a", [0.0, 1.0]), ("b", [1.0, 0.0]), ("b", [-1.0, 0.0]), ("c", [1.0, 0.0]), ("c", [1.0])]
        + [("d", [1.0, 0.0])] * 51,
        "userId string, embedding array<float>",
    )
    judged = profile.mean_profiles(df, 2)
    got = {r.userId: r for r in judged.collect()}
    assert got["a"].profile == pytest.approx([2**-0.5, 2**-0.5])
    assert [got[u].reason for u in "abcd"] == [
        None, "mean vector is near zero", "vector dimensions differ", "too many interests",
    ]
    assert rows(profile.interests_response(judged).where("userId = 'a'")) == [("a", 2, 2, "profile created")]
    assert rows(profile.good_profiles(judged), "userId") == [("a",)]


def test_mean_combines_a_hot_user_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", [1.0, 0.0])], "userId string, embedding array<float>")
    plan = profile.mean_profiles(df, 2)._jdf.queryExecution().executedPlan().toString()
    # Read upwards: summed per task, then dealt out by user, then added up.
    assert plan.index("FlatMapGroupsInArrow") < plan.index("Exchange") < plan.index("MapInArrow")

    hot = spark.range(0, 2000, 1, 4).select(
        F.concat(F.lit("u"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("string")).alias("userId"),
        F.array(F.col("id").cast("float"), F.lit(1.0).cast("float")).alias("embedding"),
    )
    settings = FeedSettings(max_interests=10_000)
    profile_ = {r.userId: r for r in profile.mean_profiles(hot, 2, settings).collect()}["u0"]
    ids = np.arange(0, 2000, 3)
    assert profile_.interestCount == len(ids)
    assert profile_.profile == pytest.approx(np.array([ids.mean(), 1]) / np.hypot(ids.mean(), 1), abs=1e-6)


def test_partial_sums_hold_little_however_many_users():
    """As many users as rows: what a task holds stays small, and nothing is lost."""
    dim, peak = 64, []
    base = pa.total_allocated_bytes()

    def batches():
        for i in range(30):
            peak.append(pa.total_allocated_bytes() - base)
            users = pa.array([f"u{j}" for j in range(i * 5000, i * 5000 + 5000)])
            flat = pa.array(np.ones(5000 * dim, np.float32))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(5001, dtype=np.int32) * dim), flat)
            yield pa.RecordBatch.from_arrays([users, lists], names=["userId", "embedding"])

    got = 0
    for sums in profile._partial_sums(batches(), dim):
        got += len(sums)
        assert set(sums.column("n").to_pylist()) == {1}
    assert got == 150_000 and max(peak) < 16 << 20
    same = pa.RecordBatch.from_arrays(
        [pa.array(["a"] * 20_000), pa.array([[1.0, 2.0]] * 20_000, pa.list_(pa.float32()))], names=["userId", "embedding"]
    )
    (one,) = profile._partial_sums(iter([same] * 3), 2)
    assert one.to_pylist() == [{"userId": "a", "n": 60_000, "lo": 2, "hi": 2, "total": [60_000.0, 120_000.0]}]


def test_users_are_added_up_without_a_call_each(spark, monkeypatch):
    """Rows of a user over several batches and partial sums, of no user, and of all lengths."""
    monkeypatch.setattr(profile, "PARTS", 2)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    vectors = [(None if i % 7 == 0 else f"u{i % 7 % 5}", [float(i), 1.0] if i != 8 else [1.0]) for i in range(40)]
    df = spark.createDataFrame(vectors, "userId string, embedding array<float>").repartition(5)
    before = spark.conf.get(name)
    spark.conf.set(name, 2)
    try:
        judged = profile.mean_profiles(df, 2)
        got = {r.userId: r for r in judged.collect()}
    finally:
        spark.conf.set(name, before)
    assert len(got) == 6
    for user in got:
        own = [v for u, v in vectors if u == user]
        assert got[user].interestCount == len(own)
        if user == "u1":
            assert got[user].reason == "vector dimensions differ"
            continue
        mean = sum(v[0] for v in own) / len(own)
        assert got[user].profile == pytest.approx([x / (mean**2 + 1) ** 0.5 for x in (mean, 1.0)], rel=1e-6)
