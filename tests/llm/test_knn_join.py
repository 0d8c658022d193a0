"""Exact neighbours against all pairs; the registered query is held against SQL too."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumefeed.llm import knn_join as kj

TABLE = "vec_id long, embedding array<float>, label int, cell string, score string, vector string"


def table(spark, vectors, ids=None):
    rows = [(i, v, 0, "x", "x", "x") for i, v in zip(ids or range(len(vectors)), vectors)]
    return spark.createDataFrame(rows, TABLE)


def brute(vectors, queries, k):
    x = np.floor(np.array(vectors, np.float32).astype(float) * 1024).astype(np.int64)
    out = set()
    for q in queries:
        scores = x @ x[q]
        best = sorted((i for i in range(len(x)) if i != q), key=lambda i: (-scores[i], i))[:k]
        out |= {(q, r + 1, i, int(scores[i])) for r, i in enumerate(best)}
    return out


def found(df):
    return {(r.query_id, r.rank, r.vec_id, r.score) for r in df.collect()}


@pytest.mark.parametrize("spread", [0.05, 2.0])
def test_equals_all_pairs(spark, monkeypatch, spread):
    """Tight clusters and none; a third of all rows is one vector; small groups and shares."""
    monkeypatch.setattr(kj, "GROUP_QUERIES", 20)
    monkeypatch.setattr(kj, "SHARE_ROWS", 100)
    monkeypatch.setattr(kj, "CELL_ROWS", 30)
    monkeypatch.setattr(kj, "CHUNK_QUERIES", 7)
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 1, (6, 8))
    vectors = [centres[i % 6] + rng.normal(0, spread, 8) for i in range(600)]
    for i in range(0, 600, 3):
        vectors[i] = vectors[0]
    vectors = [[float(np.float32(c)) for c in v] for v in vectors]
    got = found(kj.knn_join(table(spark, vectors), F.col("vec_id") % 4 == 0, k=5))
    assert got == brute(vectors, range(0, 600, 4), 5)


def test_large_values_are_exact(spark):
    vectors = [[1_000_000.0, 3.0], [2_000_000.0, 1.0], [1_999_999.875, 7.0], [-5.0, 2.0]]
    got = found(kj.knn_join(table(spark, vectors), F.col("vec_id") == 0, k=3))
    assert got == brute(vectors, [0], 3)


def test_values_beyond_32_bits_and_beyond_a_long(spark):
    """Odd rows cost nothing but themselves; a score that no long holds is the closest long."""
    largest = (1 << 63) - 1
    big = [[float(2**20)] * 64, [float(2**20)] * 64, [1.0] * 64, [-float(2**20)] * 64]
    got = found(kj.knn_join(table(spark, big), F.col("vec_id") == 0, k=3))
    assert got == {(0, 1, 1, largest), (0, 2, 2, 64 * 2**40), (0, 3, 3, -largest - 1)}
    wide = [[float(2**21), 1.0], [1.0, 0.0], [0.5, 2.0], [float(2**21), 3.0], [2.0**100, 0.0]]
    got = found(kj.knn_join(table(spark, wide), F.col("vec_id") < 2, k=4))
    exact = [[int(c * 1024) for c in v] for v in wide]
    expected = set()
    for q in (0, 1):
        dot = lambda i: min(largest, sum(a * b for a, b in zip(exact[q], exact[i])))  # noqa: E731, B023
        best = sorted((i for i in range(5) if i != q), key=lambda i: (-dot(i), i))
        expected |= {(q, r + 1, i, dot(i)) for r, i in enumerate(best)}
    assert got == expected


def test_groups_skip_cells_of_clustered_data(spark, monkeypatch):
    """Bounds from summaries leave out most cells, and copies of rows that cannot matter."""
    monkeypatch.setattr(kj, "GROUP_QUERIES", 12)
    monkeypatch.setattr(kj, "CELL_ROWS", 25)
    monkeypatch.setattr(kj, "SHARE_ROWS", 60)
    seen, learn = [], kj.Bounds.learn

    def watch(self, *args):
        learn(self, *args)
        seen.append(self)

    monkeypatch.setattr(kj.Bounds, "learn", watch)
    rng = np.random.default_rng(5)
    centres = np.eye(12) * 10
    vectors = [(centres[i % 12] + rng.normal(0, 0.02, 12)).tolist() for i in range(720)]
    vectors = [[float(np.float32(c)) for c in v] for v in vectors]
    got = found(kj.knn_join(table(spark, vectors), F.col("vec_id") % 6 == 0, k=5))
    assert got == brute(vectors, range(0, 720, 6), 5)
    needed = seen[0].needed()
    assert needed.any(axis=1).all() and needed.mean() < 0.4
    x = np.floor(np.array(vectors) * 1024)
    assert seen[0].rows(x).mean() < 0.4


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 0.5], None, [nan, 1.0], [inf, 1.0], [None, 1.0], [], [1.0], [0.25, 1.0, 9.0], [1.0, 0.5], [7.0, 7.0]]
    ids = [0, 1, 2, 3, 4, 5, 6, 7, 0, None]
    got = found(kj.knn_join(table(spark, vectors, ids), F.col("vec_id") % 2 == 0, k=10))
    one = 1024 * 1024
    # Shorter vectors are filled up with zeros; vector 0 comes twice and counts once.
    assert got == {
        (0, 1, 6, one),
        (0, 2, 7, one // 4 + one // 2),
        (6, 1, 0, one),
        (6, 2, 7, one // 4),
    }
    assert found(kj.knn_join(table(spark, []), F.col("vec_id") >= 0)) == set()
    assert found(kj.knn_join(table(spark, [[1.0]]), F.col("vec_id") >= 0)) == set()
    assert found(kj.knn_join(table(spark, [[1.0], [2.0]]), F.col("vec_id") > 9)) == set()
