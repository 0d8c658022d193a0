"""Inverted lists: recall, the promise of exact answers, crowded lists, odd tables."""

import numpy as np
import pytest
from engine_helpers import rows

from plumefeed.operators import ivf
from plumefeed.operators.knn import KnnSettings, knn

DIM, K = 8, 10


def vectors(spark, prefix, found, kind):
    table = [(f"{prefix}{i:05d}", None if v is None else [float(x) for x in v]) for i, v in enumerate(found)]
    return spark.createDataFrame(table, f"{kind[0]} string, {kind[1]} array<float>")


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 1, (20, DIM))
    points = [centres[i % 20] + rng.normal(0, 0.1, DIM) for i in range(1200)]
    points[::3] = [points[0]] * len(points[::3])
    users = [centres[i % 20] + rng.normal(0, 0.1, DIM) for i in range(40)]
    return (
        vectors(spark, "u", users, ("userId", "profile")),
        vectors(spark, "", points, ("point_id", "embedding")),
    )


def test_few_probes_find_nearly_all_where_vectors_cluster(spark, clustered):
    users, points = clustered
    lists = ivf.InvertedLists.build(points, DIM, lists=30, block_points=100)
    assert lists.sizes.sum() == 1200 and lists.blocks.max() > 1
    found, sure = lists.search(users, K, probes=4, settings=KnnSettings(chunk_users=7))
    exact = knn(users, points, K, DIM)
    measured = ivf.recall(found, exact).first()
    assert measured.hits == 40 * K and measured.recall >= 0.95
    # Who is told to have the exact answer has it.
    promised = {r.userId for r in sure.collect() if r.exact}
    pick = lambda df: [r for r in rows(df, "userId", "point_id", "cosine") if r[0] in promised]
    assert promised and pick(found) == pick(exact)


def test_more_probes_never_lose_and_all_are_exact(spark, clustered):
    users, points = clustered
    lists = ivf.InvertedLists.build(points, DIM, lists=12)
    exact, last = knn(users, points, K, DIM), 0.0
    for probes in (1, 4, len(lists.centres)):
        found, sure = lists.search(users, K, probes)
        now = ivf.recall(found, exact).first().recall
        assert now >= last
        last = now
    assert last == 1.0 and rows(found) == rows(exact)
    assert {r.exact for r in sure.collect()} == {True}


def test_probes_are_set_by_a_sample(spark, clustered):
    users, points = clustered
    lists = ivf.InvertedLists.build(points, DIM, lists=30)
    probes = lists.probes_for(users, K, target=0.9, users=15)
    assert 1 <= probes < len(lists.centres) // 2
    found, _ = lists.search(users, K, probes)
    assert ivf.recall(found, knn(users, points, K, DIM)).first().recall >= 0.85
    assert lists.probes_for(users, K, target=1.0) >= probes


def test_odd_tables(spark):
    users = vectors(spark, "u", [[1.0] * DIM, [0.0] * DIM], ("userId", "profile"))
    none = vectors(spark, "", [None], ("point_id", "embedding"))
    found, sure = ivf.InvertedLists.build(none, DIM).search(users, K, 3)
    assert found.collect() == sure.collect() == []
    few = vectors(spark, "", [[1.0] * DIM, None, [0.0] * DIM, [-1.0] * DIM], ("point_id", "embedding"))
    found, sure = ivf.InvertedLists.build(few, DIM).search(users, K, 1)
    assert rows(found) == rows(knn(users, few, K, DIM))
    assert {r.exact for r in sure.collect()} == {True}


def test_recall_compares_many_users_at_once(spark, monkeypatch):
    """Equal to a join of the rows, with users on one side only and pairs that come twice."""
    monkeypatch.setattr(ivf, "PARTS", 2)
    rng = np.random.default_rng(12)
    pairs = lambda n: [(f"u{u}", f"p{p}", 0.5) for u, p in rng.integers(0, 12, (n, 2)).tolist()]
    schema = "userId string, point_id string, cosine double"
    exact, found = pairs(90) + [("alone", "p1", 0.5)], pairs(60) + [("other", "p1", 0.5)]
    key = lambda r: r[:2]
    seen = [sum(key(f) == key(e) for f in found) for e in exact]
    got = ivf.recall(spark.createDataFrame(found, schema), spark.createDataFrame(exact, schema)).first()
    assert (got.hits, got.found) == (sum(max(s, 1) for s in seen), sum(seen))
    assert ivf._parted(spark.createDataFrame(exact, schema)).select("part").distinct().count() <= 2
