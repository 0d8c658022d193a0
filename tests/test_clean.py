import pytest
from engine_helpers import rows
from pyspark.sql import functions as F

from plumefeed.constants import FEATURE_COLUMNS, POSITION
from plumefeed.functions import wordpiece
from plumefeed.operators import clean, dedup

SEP = "\x01"
BASE = {
    "text_tokens": SEP.join(["2", "8", "9", "3"]),
    "hashtags": SEP.join(["winter", "night", "42"]),
    "tweet_id": "9007",
    "present_media": SEP.join(["Video", "Photo"]),
    "tweet_type": "Quote",
    "language": "nl",
    "tweet_timestamp": "1704067201",
    "engaged_with_user_id": "w-77",
    "engaged_with_user_follower_count": "86",
}


def line(**changed):
    values = BASE | changed
    return "\t".join(values.get(c, "") for c in FEATURE_COLUMNS)


def parse(spark, *lines):
    return clean.parse_lines(spark.createDataFrame([(x,) for x in lines], "line string")).collect()


def test_twenty_columns():
    assert len(FEATURE_COLUMNS) == 20
    assert POSITION["tweet_timestamp"] == 8


def test_good_line(spark):
    (row,) = parse(spark, line())
    assert row.reason is None
    assert (row.tweetId, row.language, row.tweetTimestamp) == ("9007", "nl", 1704067201)
    assert row.textTokens == [2, 8, 9, 3]
    assert row.hashtags == ["winter", "night", "42"]
    assert row.presentMedia == ["Video", "Photo"]
    assert (row.tweetType, row.authorId, row.authorFollowerCount) == ("Quote", "w-77", 86)


@pytest.mark.parametrize(
    "bad, reason",
    [
        (None, "blank line"),
        ("", "blank line"),
        ("   ", "blank line"),
        ("a\tb\tc", "too few columns"),
        (line(tweet_id=""), "blank tweet_id"),
        (line(tweet_id=" \x01 "), "blank tweet_id"),
        (line(text_tokens=""), "blank text_tokens"),
        (line(text_tokens="\x01"), "blank text_tokens"),
        (line(text_tokens=f"8{SEP}abc"), "token is not a number"),
        (line(text_tokens=f"8{SEP}1.5"), "token is not a number"),
        (line(text_tokens=f"8{SEP}2147483648"), "token is not a number"),
        (line(text_tokens=f"8{SEP} {SEP}5"), "token is not a number"),
        (line(text_tokens="8\x7f"), "token is not a number"),
        (line(language=" "), "blank language"),
        (line(tweet_timestamp="soon"), "tweet_timestamp is not a number"),
        (line(tweet_timestamp=""), "tweet_timestamp is not a number"),
        (line(tweet_timestamp="0"), "tweet_timestamp is not positive"),
        (line(tweet_timestamp="-1704067201"), "tweet_timestamp is not positive"),
    ],
)
def test_reject_reasons(spark, bad, reason):
    assert parse(spark, bad)[0].reason == reason


def test_first_broken_rule_wins(spark):
    assert parse(spark, line(tweet_id="", language="", text_tokens="x"))[0].reason == "blank tweet_id"


def test_tolerated_lines(spark):
    got = parse(
        spark,
        line(hashtags=""),
        line(engaged_with_user_follower_count="x"),
        line(engaged_with_user_follower_count="-7"),
        line() + "\textra\textra",
        line(tweet_id=" \x01abc \x01"),
        line(text_tokens=f"{SEP}{SEP}+5{SEP}{SEP} 6 {SEP}"),
        line(hashtags=f"a b{SEP}{SEP} c"),
        line(tweet_timestamp=" 1704067202 "),
    )
    assert all(r.reason is None for r in got)
    assert got[0].hashtags == []
    assert [got[1].authorFollowerCount, got[2].authorFollowerCount] == [0, -7]
    assert got[4].tweetId == "abc"
    assert got[5].textTokens == [5, 6]
    assert got[6].hashtags == ["a b", " c"]
    assert got[7].tweetTimestamp == 1704067202


# Each special token by itself and inside words; tails at the start, after one another, after
# an unknown id; ids just outside the vocabulary on both sides.
DECODING = [
    ([9, 10, 11, 8], "over the old moon"),
    ([7, 5], "snowberg"),
    ([7, 5, 6, 13], "snowberges"),
    ([5, 5, 7, 8], "bergbergsnow moon"),
    ([6], "e"),
    ([12, 13, 10], "1990s the"),
    ([0, 1, 2, 3, 4], ""),
    ([2, 7, 0, 5, 4, 8, 3], "snowberg moon"),
    ([14, 7, 14, 5], "snowberg"),
    ([-2147483648, 8, -1, 6], "moone"),
    ([], ""),
    (None, None),
]


def test_decode_in_place(spark, toy_vocab):
    decode = wordpiece.decoder(spark, wordpiece.shared_vocab(toy_vocab))
    df = spark.createDataFrame([(i, ids) for i, (ids, _) in enumerate(DECODING)], "n int, ids array<int>")
    assert rows(df.select("n", decode(F.col("ids")))) == sorted(((i, t) for i, (_, t) in enumerate(DECODING)), key=repr)


def test_decode_by_join_agrees(spark, toy_vocab):
    cases = [c for c in DECODING if c[0] is not None]
    df = spark.createDataFrame([(i, ids) for i, (ids, _) in enumerate(cases)], "n int, ids array<int>")
    got = wordpiece.decode_by_join(df, "n", "ids", toy_vocab)
    assert rows(got) == sorted(((i, t) for i, (_, t) in enumerate(cases)), key=repr)


def test_decode_by_join_moves_different_ids_only(spark, toy_vocab):
    """A long text of few different ids: what leaves the join is one row per different id."""
    ids = [9, 10, 11, 8, 99, None] * 5_000
    df = spark.createDataFrame([(1, ids), (2, None), (3, [8])], "n int, ids array<int>")
    got = wordpiece.decode_by_join(df, "n", "ids", toy_vocab)
    text = " ".join(["over the old moon"] * 5_000)
    assert rows(got) == [(1, text), (2, ""), (3, "moon")]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "array_distinct" in plan and "posexplode" not in plan


def test_decode_by_join_merges_rows_of_one_key(spark, toy_vocab):
    """As it always was: rows of one key are read place by place, tokens in their order."""
    df = spark.createDataFrame([(1, [9, 8]), (1, [7, 5, 10]), (None, [8])], "n int, ids array<int>")
    got = wordpiece.decode_by_join(df, "n", "ids", toy_vocab)
    assert rows(got) == [(1, "over snowberg moon the"), (None, "moon")]


def test_vocabulary_bounds(spark, toy_vocab):
    with pytest.raises(ValueError, match="more than 13"):
        wordpiece.shared_vocab(toy_vocab, limit=13)
    assert len(wordpiece.shared_vocab(toy_vocab, limit=14)) == 14
    with pytest.raises(ValueError):
        wordpiece.shared_vocab(toy_vocab.limit(0))
    with pytest.raises(ValueError):
        wordpiece.shared_vocab(toy_vocab.where("token_id <> 3"))


def _lines(spark):
    ids = SEP.join("2 9 10 7 5 13 3".split())
    return spark.createDataFrame(
        [
            (line(text_tokens=ids, tweet_id="t1", present_media=""),),
            (line(text_tokens=f"2{SEP}3", tweet_id="t2"),),
            (line(text_tokens=ids, tweet_id="t1", present_media=""),),
            ("junk",),
        ],
        "line string",
    )


def test_clean_job(spark, toy_vocab):
    cleaned = clean.clean_lines(_lines(spark), toy_vocab)
    good = clean.accepted(cleaned).collect()
    assert [(r.tweetId, r.text, r.hasMedia) for r in good] == [("t1", "over the snowbergs", False)] * 2
    assert sorted(r.reason for r in clean.rejected(cleaned).collect()) == ["text too short", "too few columns"]


def test_messages_have_all_fields(spark, toy_vocab):
    message = clean.to_messages(clean.accepted(clean.clean_lines(_lines(spark), toy_vocab))).first()
    assert message.key == "t1"
    assert message.value == (
        '{"tweetId":"t1","text":"over the snowbergs","language":"nl","tweetType":"Quote",'
        '"tweetTimestamp":1704067201,"authorId":"w-77","authorFollowerCount":86,'
        '"hashtags":["winter","night","42"],"hasMedia":false}'
    )


def test_dedup_keeps_the_earliest(spark):
    df = spark.createDataFrame(
        [("a", 3, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", 2, "w")],
        "tweetId string, tweetTimestamp long, text string",
    )
    assert rows(dedup.dedup_posts(df)) == [("a", 1, "y"), ("b", 2, "w")]
    assert rows(dedup.newest(df, "tweetId", "tweetTimestamp")) == [("a", 3, "x"), ("b", 2, "w")]


def test_dedup_combines_copies_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("'hot' as tweetId", "id as tweetTimestamp", "'t' as text")
    plan = dedup.dedup_posts(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan
    assert rows(dedup.dedup_posts(df)) == [("hot", 0, "t")]
