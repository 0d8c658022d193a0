import math

import pytest
from engine_helpers import rows
from pyspark.sql import functions as F

from plumefeed import FeedSettings
from plumefeed.functions.ids import partition_of, point_id
from plumefeed.functions.ranking import final_score, normalize_similarity, recency_score
from plumefeed.functions.vectors import cosine, l2_normalize

NOW = 1700000000


def value(spark, c):
    return spark.range(1).select(c).first()[0]


@pytest.mark.parametrize("cos, expected", [(1, 1), (0, 0.5), (-1, 0), (2, 1), (-3, 0)])
def test_similarity(spark, cos, expected):
    assert value(spark, normalize_similarity(F.lit(float(cos)))) == pytest.approx(expected, abs=1e-6)


@pytest.mark.parametrize(
    "ts, expected",
    [(NOW, 1), (NOW - 86400, math.exp(-1)), (NOW + 3600, 1), (0, 0), (-5, 0)],
)
def test_recency(spark, ts, expected):
    assert value(spark, recency_score(F.lit(ts), NOW)) == pytest.approx(expected, abs=1e-6)


def test_fresher_is_higher(spark):
    fresh, old = (value(spark, recency_score(F.lit(NOW - h * 3600), NOW)) for h in (1, 72))
    assert fresh > old


def score(spark, cos, ts, **settings):
    return value(spark, final_score(F.lit(float(cos)), F.lit(ts), NOW, FeedSettings(**settings)))


def test_final_score(spark):
    assert score(spark, 0.6, NOW) == pytest.approx(0.85 * 0.8 + 0.15, abs=1e-6)
    assert score(spark, 0.9, NOW - 96 * 3600) > score(spark, -0.2, NOW)
    assert score(spark, 0.5, NOW) > score(spark, 0.5, NOW - 48 * 3600)
    assert score(spark, 0.5, NOW, semantic_weight=0.0, recency_weight=1.0) == pytest.approx(1.0)


def test_settings_from_the_session(spark):
    spark.conf.set("spark.plumefeed.semantic_weight", "0.7")
    spark.conf.set("spark.plumefeed.recency_weight", "a lot")
    spark.conf.set("spark.plumefeed.pool_size", "50")
    try:
        found = FeedSettings.from_conf(spark)
    finally:
        for name in ("semantic_weight", "recency_weight", "pool_size"):
            spark.conf.unset(f"spark.plumefeed.{name}")
    assert (found.semantic_weight, found.recency_weight, found.pool_size) == (0.7, 0.15, 50)


def test_point_ids_are_uuid5(spark):
    import uuid

    names = ["abc", "1", "ğüş", "x" * 200, ""]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert rows(df.select("n", point_id(F.col("n")))) == sorted(
        [(n, str(uuid.uuid5(uuid.NAMESPACE_URL, n))) for n in names], key=repr
    )


def test_partitions_are_stable_and_bounded(spark):
    df = spark.range(1000).select(partition_of(F.col("id").cast("string"), 3).alias("p"))
    counts = {r.p: r["count"] for r in df.groupBy("p").count().collect()}
    assert set(counts) == {0, 1, 2} and min(counts.values()) > 250


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    got = df.select(cosine(F.col("a"), F.col("b")), l2_normalize(F.col("a"))).collect()
    assert got[0][0] == pytest.approx(24 / 25)
    assert got[0][1] == pytest.approx([0.6, 0.8])
    assert (got[1][0], got[1][1]) == (0.0, None)
