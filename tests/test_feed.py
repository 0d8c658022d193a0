import random

import pytest
from engine_helpers import rows
from pyspark.sql import functions as F

from plumefeed import FeedSettings
from plumefeed.functions.text import content_words, jaccard
from plumefeed.operators import feed, monitor

NOW = 1706745600


def similarity(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    return df.select(jaccard(content_words(F.col("a")), content_words(F.col("b")))).first()[0]


def wording(*ranges):
    """A text of the numbered words of some ranges."""
    return " ".join(f"word{i:02d}" for r in ranges for i in r)


@pytest.mark.parametrize(
    "shared, left, right, near",
    [
        (2, 2, 1, True),  # 2 / 5, the threshold itself
        (4, 5, 1, True),  # 4 / 10
        (39, 30, 29, False),  # 39 / 98, just below
        (41, 30, 30, True),  # 41 / 101, just above
        (0, 9, 9, False),
        (1, 0, 0, True),
    ],
)
def test_word_sets_around_the_threshold(spark, shared, left, right, near):
    one = wording(range(shared), range(shared, shared + left))
    other = wording(range(500, 500 + right), range(shared))
    ratio = similarity(spark, one, other)
    assert ratio == pytest.approx(shared / (shared + left + right))
    assert (ratio >= 0.40) is near


def test_words(spark):
    texts = ["Große Tabellen, schnelle JOINS!", "große tabellen schnelle joins", "", "a bc def", "𝒜𝒷 x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(F.array_sort(content_words(F.col("t")))).collect()]
    assert got[0] == got[1] == ["große", "joins", "schnelle", "tabellen"]
    assert got[2] == got[3] == []
    assert got[4] == ["𝒜𝒷"]  # two letters, four UTF-16 units


@pytest.mark.parametrize("a, b, expected", [([], [], 1.0), ("ab", "ab", 1.0), ("a", "b", 0.0), ("ab", "a", 0.5)])
def test_jaccard(spark, a, b, expected):
    df = spark.createDataFrame([(list(a), list(b))], "a array<string>, b array<string>")
    assert df.select(jaccard(F.col("a"), F.col("b"))).first()[0] == expected


def ranked(spark, items, limit=None):
    """Items (userId, id, text, score) as ranked candidates."""
    order = sorted(items, key=lambda x: (x[0], -x[3], x[1]))
    seen, out = {}, []
    for user, id_, text, score in order:
        seen[user] = seen.get(user, 0) + 1
        out.append((user, id_, text, score, score, 1.0, score, seen[user]))
    df = spark.createDataFrame(
        out,
        "userId string, point_id string, text string, cosine double, semanticSimilarity double, "
        "recencyScore double, finalScore double, position int",
    )
    points = df.select("point_id", "text").distinct()
    df = df.drop("text")
    return (df.withColumn("limit", F.lit(limit)) if limit else df), points


def kept(df):
    return [r.point_id for r in df.orderBy("userId", "rank").collect()]


def test_a_match_is_the_best_kept_item(spark):
    """The third item is near to the second only, which is near to the first and goes."""
    df, points = ranked(
        spark,
        [
            ("u", "b", wording(range(0, 10)), 0.9),
            ("u", "c", wording(range(5, 15)), 0.8),  # 5 / 15 with the first
            ("u", "a", wording(range(8, 18)), 0.7),  # 2 / 18 and 7 / 13
            ("u", "d", wording(range(3, 10)), 0.6),  # 7 / 10 and 5 / 12
            ("u", "e", wording(range(40, 42)), 0.5),
            ("v", "a", wording(range(8, 18)), 0.1),
        ],
    )
    worded = feed.with_words(df, points)
    assert kept(feed.drop_near_duplicates(worded)) == ["b", "c", "e", "a"]
    matches = feed.near_duplicate_matches(worded)
    assert rows(matches, "point_id", "kept_point_id") == [("a", "c"), ("d", "b")]


def greedy(items, threshold=0.40):
    """The rule, spelled out."""
    sets, out = [], []
    for id_, text in items:
        words = {w for w in text.lower().split() if len(w) >= 4}
        near = any(
            (not s and not words) or (s | words and len(s & words) / len(s | words) >= threshold) for s in sets
        )
        if not near:
            sets.append(words)
            out.append(id_)
    return out


def random_items(seed, users=6, n=60):
    rng = random.Random(seed)
    words = [f"word{i}" for i in range(14)] + ["a", "of"]
    return [
        (f"u{u}", f"{u}-{i:03d}", " ".join(rng.choices(words, k=rng.randint(0, 7))), rng.random())
        for u in range(users)
        for i in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_walk_against_brute_force(spark, seed):
    items = random_items(seed)
    df, points = ranked(spark, items)
    expected = []
    for user in sorted({x[0] for x in items}):
        own = sorted((x for x in items if x[0] == user), key=lambda x: (-x[3], x[1]))
        expected += greedy([(x[1], x[2]) for x in own])
    assert kept(feed.drop_near_duplicates(feed.with_words(df, points))) == expected


@pytest.mark.parametrize("limit", [1, 3, 8, 50])
def test_limited_walk_is_the_start_of_the_whole_one(spark, limit):
    """Small limits end in the first round, larger ones need the second."""
    items = random_items(7)
    whole, points = ranked(spark, items)
    df, _ = ranked(spark, items, limit)
    by_user = {}
    for r in feed.drop_near_duplicates(feed.with_words(whole, points)).orderBy("rank").collect():
        by_user.setdefault(r.userId, []).append(r.point_id)
    got = {}
    for r in feed.take_distinct(df, points).orderBy("rank").collect():
        got.setdefault(r.userId, []).append(r.point_id)
    assert got == {u: ids[:limit] for u, ids in by_user.items()}


def test_limits(spark):
    df = spark.createDataFrame([(None,), (0,), (-3,), (7,), (500,)], "l int")
    assert [r[0] for r in df.select(feed.clamp_limit(F.col("l"))).collect()] == [20, 1, 1, 7, 100]


ASKED = "requestId string, userId string, limit int"


def small_world(spark):
    profiles = spark.createDataFrame([("u", [1.0, 0.0])], "userId string, profile array<float>")
    rows_ = [
        ("p1", "t1", "alpha beta gamma", None, NOW, None, None, [1.0, 0.0]),
        ("p2", None, "lost without an id", "en", NOW, "a", ["x"], [1.0, 0.0]),
        ("p3", "t3", None, "en", NOW, "a", ["x"], [1.0, 0.0]),
        ("p4", "t4", "delta epsilon", "en", None, "a", ["x"], [0.9, 0.1]),
        ("p5", "t5", "omega theta", "en", NOW - 86400, "a", ["x"], [0.0, 1.0]),
    ]
    points = spark.createDataFrame(
        rows_,
        "point_id string, tweetId string, text string, language string, tweetTimestamp long, "
        "authorId string, hashtags array<string>, embedding array<float>",
    )
    return profiles, points


def test_feed_end_to_end(spark):
    profiles, points = small_world(spark)
    asked = spark.createDataFrame([("r", "u", None), ("s", "stranger", 5)], ASKED)
    got = feed.build_feeds(asked, profiles, points, NOW, 2).orderBy("rank").collect()
    assert [(r.rank, r.tweetId) for r in got] == [(1, "t1"), (2, "t4"), (3, "t5")]
    assert (got[0].language, got[0].authorId, got[0].hashtags) == ("", "", [])
    assert got[0].finalScore == pytest.approx(1.0)
    assert (got[1].tweetTimestamp, got[1].recencyScore) == (0, 0.0)
    served, missing = feed.split_requests(asked, profiles)
    assert rows(missing, "userId") == [("stranger",)]


def test_the_pool_is_cut_before_unusable_hits_are_dropped(spark):
    profiles, points = small_world(spark)
    asked = spark.createDataFrame([("r", "u", None)], ASKED)
    got = feed.build_feeds(asked, profiles, points, NOW, 2, FeedSettings(pool_size=3))
    assert rows(got, "tweetId") == [("t1",)]


def test_every_request_has_its_own_answer(spark):
    """Several requests of one user, the same one twice and with other limits."""
    profiles, _ = small_world(spark)
    points = spark.createDataFrame(
        [(f"p{i}", f"t{i}", wording([i]), "en", NOW, "a", [], [1.0, i / 10]) for i in range(8)],
        "point_id string, tweetId string, text string, language string, tweetTimestamp long, "
        "authorId string, hashtags array<string>, embedding array<float>",
    )
    requests = [("r1", "u", 6), ("r2", "u", 6), ("r3", "u", 2), ("r4", "u", None), ("r5", "x", 3)]
    asked = spark.createDataFrame(requests, ASKED)
    got = feed.build_feeds(asked, profiles, points, NOW, 2, FeedSettings(pool_size=6))
    best = [f"t{i}" for i in range(6)]
    answers = {}
    for r in got.orderBy("requestId", "rank").collect():
        answers.setdefault((r.requestId, r.userId), []).append(r.tweetId)
    assert answers == {("r1", "u"): best, ("r2", "u"): best, ("r3", "u"): best[:2], ("r4", "u"): best}


def test_responses_and_comparison(spark):
    df = spark.createDataFrame(
        [("u", 2, "b"), ("u", 1, "a"), ("v", 1, "b"), ("v", 2, "a"), ("w", 1, "c")],
        "userId string, rank int, tweetId string",
    ).withColumn("requestId", F.col("userId"))
    asked = df.select("requestId", "userId").distinct()
    got = {r.userId: r for r in feed.feed_responses(asked, df).collect()}
    assert (got["u"]["count"], [i.tweetId for i in got["u"]["items"]]) == (2, ["a", "b"])
    assert rows(feed.shared_feeds(df)) == [(["a", "b"], 2), (["c"], 1)]
    assert rows(monitor.feeds_differ(df, "u", "v")) == [(False,)]
    assert rows(monitor.feeds_differ(df, "u", "w")) == [(True,)]
