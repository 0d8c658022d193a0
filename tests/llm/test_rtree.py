"""Hard negatives against all pairs; boxes are skipped; values beyond a long; odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumefeed.llm import rtree, vectors

TABLE = "vec_id long, embedding array<double>, label int, tile string, share string, chunk string, goal string, score string, vector string"
LONG = (1 << 63) - 1


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, *["x"] * 6) for i, v, label in rows], TABLE)


def brute(rows, is_anchor, positives=5, negatives=3, window=(50, 95), scale=256):
    own = {}
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        x = [int(np.floor(c * scale)) for c in v]
        if i not in own or (label, x) < own[i]:
            own[i] = (label, x)
    cut = lambda s: max(-LONG - 1, min(LONG, s))
    dot = lambda a, b: cut(sum(p * q for p, q in zip(a, b)))
    out = set()
    for a, (label, x) in own.items():
        if not is_anchor(a):
            continue
        scores = {i: dot(x, y) for i, (_, y) in own.items() if i != a}
        first = lambda ids: sorted(ids, key=lambda i: (-scores[i], i))
        for p in first(i for i in scores if own[i][0] == label)[:positives]:
            s = scores[p]
            near = [
                i
                for i in scores
                if own[i][0] != label and window[0] * s <= 100 * scores[i] <= window[1] * s
            ]
            out |= {(a, p, r + 1, i, s, scores[i]) for r, i in enumerate(first(near)[:negatives])}
    return out


def found(df):
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("spread", [0.1, 1.0])
def test_equals_all_pairs(spark, monkeypatch, spread):
    """Small shares, leaves and chunks; a third of all rows is one vector; skewed labels."""
    monkeypatch.setattr(rtree, "SHARE_ROWS", 64)
    monkeypatch.setattr(rtree, "CHUNK_ANCHORS", 30)
    monkeypatch.setattr(rtree, "LEAF", 4)
    rng = np.random.default_rng(8)
    centres = rng.normal(0, 1, (5, 6))
    data = [(centres[i % 5] + rng.normal(0, spread, 6), int(i % 5 if i % 4 else 0)) for i in range(450)]
    rows = [(i, (data[0][0] if i % 3 == 0 else v).round(2).tolist(), label) for i, (v, label) in enumerate(data)]
    got = found(rtree.hard_negatives(table(spark, rows), F.col("vec_id") % 9 == 0))
    expected = brute(rows, lambda i: i % 9 == 0)
    assert expected and got == expected


def test_search_opens_few_boxes_of_clustered_rows():
    rng = np.random.default_rng(2)
    centres = rng.integers(-2000, 2000, (40, 8))
    x = np.concatenate([c + rng.integers(-20, 20, (100, 8)) for c in centres]).astype(np.float64)
    labels = np.repeat(np.arange(40) % 4, 100)
    tree = rtree.Tree(x, labels, np.arange(len(x)))
    scores = (x @ x[5]).astype(np.int64)
    ends = np.array([-LONG - 1]), np.array([LONG])
    best = tree.search(x[5], 5, labels[5], True, 5, *ends)[0]
    same = [i for i in range(len(x)) if labels[i] == labels[5] and i != 5]
    assert best == [(int(scores[i]), i) for i in sorted(same, key=lambda i: (-scores[i], i))[:5]]
    assert 0 < tree.opened <= 0.2 * len(tree.levels[0][0])
    tree.opened = 0
    low, high = np.array([best[-1][0] // 2]), np.array([best[-1][0] * 95 // 100])
    near = tree.search(x[5], 5, labels[5], False, 3, low, high)[0]
    other = [i for i in range(len(x)) if labels[i] != labels[5] and low[0] <= scores[i] <= high[0]]
    assert near == [(int(scores[i]), i) for i in sorted(other, key=lambda i: (-scores[i], i))[:3]]
    assert tree.opened <= 0.5 * len(tree.levels[0][0])


def test_intervals_hold_all_products():
    rng = np.random.default_rng(4)
    for size in (10, 2**40):
        x = rng.integers(-size, size, (200, 5)).astype(float)
        q = rng.integers(-size, size, 5).astype(float)
        least, most = rtree.interval(x.min(0)[None], x.max(0)[None], np.maximum(q, 0), np.minimum(q, 0))
        exact = [sum(int(a) * int(b) for a, b in zip(row, q)) for row in x]
        assert least[0] <= min(exact) and max(exact) <= most[0]


def test_values_beyond_a_long(spark):
    """Scores that no long holds are the closest long; none wraps around."""
    rows = [(i, [2.0**k, 1.0, -(2.0**j)], i % 2) for i, (k, j) in enumerate([(30, 3), (25, 30), (12, 5), (40, 2), (3, 3), (12, 1)])]
    rows += [(100, [-(2.0**45), 5.0, 1.0], 0), (101, [1.5, 2.5, 0.5], 1)]
    got = found(rtree.hard_negatives(table(spark, rows), F.col("vec_id") >= 0, positives=2, scale=1024))
    expected = brute(rows, lambda i: True, positives=2, scale=1024)
    assert got == expected
    a = vectors.products(np.array([[2.0**40, 1.0]]), np.array([[2.0**40, 3.0], [-(2.0**40), 0.0], [4.0, 5.0]]))
    assert a.tolist() == [[LONG, -LONG - 1, 2**42 + 5]]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1),
        (1, None, 1),
        (2, [nan, 1.0], 1),
        (3, [inf, 1.0], 2),
        (4, [None, 1.0], 2),
        (5, [], 2),
        (6, [1.0], 1),
        (7, [0.75, 0.25, 9.0], 2),
        (0, [1.0, 0.5], 1),
        (8, [0.5, 0.5], None),
        (None, [7.0, 7.0], 2),
        (9, [0.75, 0.25], 2),
        (10, [-1.0, 0.0], 1),
    ]
    got = found(rtree.hard_negatives(table(spark, rows), F.col("vec_id") % 2 == 0))
    expected = brute(rows, lambda i: i % 2 == 0)
    assert expected and got == expected
    for few in ([], [(0, [1.0], 1)], [(1, [1.0], 1), (3, [2.0], 2)], [(0, None, 1)]):
        assert found(rtree.hard_negatives(table(spark, few), F.col("vec_id") % 2 == 0)) == set()


def test_packing_and_unpacking():
    import pyarrow as pa

    x = np.array([[1.0, -2.0**31 + 1], [2.0**52, -3.0], [0.0, 0.0]])
    packed = pa.array(vectors._packed(x), pa.binary())
    assert vectors.matrix(packed, 2).tolist() == x.tolist()
    assert vectors.matrix(packed.slice(2, 1), 3).tolist() == [[0.0, 0.0, 0.0]]
