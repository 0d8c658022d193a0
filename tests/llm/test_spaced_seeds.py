"""Benchmark passages: planted with substitutions, and every pair in plain Python."""

import random
import re
from itertools import combinations

import numpy as np

from plumefeed.llm import spaced_seeds

ITEMS = "item_id long, text string, doc_id long, seeds string"


def overlaps(docs, items):
    rows = spaced_seeds.overlaps(docs, items).collect()
    return {(r.doc_id, r.item_id): tuple(r)[2:] for r in rows}


def test_planted_passages(spark, documents):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passages = [[word() for _ in range(n)] for n in (6, 12, 40, 300)]
    items = spark.createDataFrame(
        [(i, " ".join(p), i, "x") for i, p in enumerate(passages)]
        + [(90, None, 1, "x"), (91, "", 1, "x"), (92, "too short", 1, "x"), (None, "no id", 1, "x")],
        ITEMS,
    )
    rows, expected = [], {}
    for i, passage in enumerate(passages):
        for changed in (0, len(passage) // 10):
            copy = list(passage)
            # Not at the ends, so that the whole passage is the best overlap.
            for k in range(changed):
                copy[3 + k * 10] = word()
            before = [word() for _ in range(rng.randrange(5, 90))]
            text = ", ".join(before).upper() + ".\n" + " ".join(copy) + " " + " ".join(word() for _ in range(50))
            rows.append((len(rows), text, "en"))
            n = len(passage)
            expected[(len(rows) - 1, i)] = (len(before), 0, n, n - changed)
    rows += [(len(rows) + k, " ".join(word() for _ in range(400)), "en") for k in range(20)]
    assert overlaps(documents(rows), items) == expected


def test_finds_what_plain_python_finds(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    words = lambda t: re.findall("[0-9a-z\x80-\U0010ffff]+", t.lower())
    grams = {}
    for r in items.collect():
        w = words(r.text)
        for k in range(len(w) - 11):
            grams.setdefault(tuple(w[k : k + 12]), set()).add(r.item_id)
    expected = set()
    for r in docs.collect():
        w = words(r.text or "")
        for k in range(len(w) - 11):
            expected |= {(r.doc_id, i) for i in grams.get(tuple(w[k : k + 12]), ())}
    got = set(overlaps(docs, items))
    assert expected and expected <= got
    # What comes on top has substitutions, or is shorter than the runs above.
    assert {d for d, _ in got} - {d for d, _ in expected} <= {
        r.doc_id for r in spaced_seeds.overlaps(docs, items).where("n_same >= 10").collect()
    }


def test_odd_rows(spark, odd, nothing):
    items = spark.createDataFrame(
        [(1, "with the same id and text a row that comes twice with the same id and text", 1, "x")], ITEMS
    )
    none = items.limit(0)
    assert set(overlaps(odd, items)) == {(9, 1)}
    assert overlaps(odd, none) == overlaps(nothing, items) == {}
    left = spaced_seeds.drop_contaminated(odd, items)
    assert left.columns == odd.columns
    assert left.count() == odd.count() - 2


def every_stretch(same, identity=0.8):
    """Most equal words, then shortest, then first, of all stretches with the share."""
    fits = [
        (-sum(same[a:b]), b - a, a, b)
        for a in range(len(same))
        for b in range(a + 1, len(same) + 1)
        if sum(same[a:b]) * 10 >= round(identity * 10) * (b - a) and any(same[a:b])
    ]
    return min(fits)[2:] if fits else (0, 0)


def test_extent_equals_all_stretches():
    rng = random.Random(9)
    lines = [[i not in gone for i in range(n)] for n in (15, 16) for gone in combinations(range(n), 3)]
    for _ in range(300):
        share = rng.choice([0.5, 0.7, 0.78, 0.9])
        lines.append([rng.random() < share for _ in range(rng.randrange(1, 60))])
    for same in lines:
        assert spaced_seeds._extent(np.array(same), 0.8) == every_stretch(same), same


def test_substitutions_near_the_ends_and_poor_surroundings(spark, documents):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    short, long = [word() for _ in range(15)], [word() for _ in range(140)]
    items = spark.createDataFrame([(0, " ".join(short), 0, "x"), (1, " ".join(long), 1, "x")], ITEMS)
    # Of the long passage 12 words in a row are left, then three of four, far to the right.
    poor = {i for i in range(140) if not 10 <= i < 22 and i % 4 == 0} | {22, 23, 24}
    changes = [(short, gone) for gone in ({4, 5}, {1, 13}, {0, 7, 14}, {1, 3, 12})] + [(long, poor)]
    rows, expected = [], {}
    for k, (passage, gone) in enumerate(changes):
        copy = [word() if i in gone else w for i, w in enumerate(passage)]
        rows.append((k, " ".join([word() for _ in range(30)] + copy + [word() for _ in range(30)]), "en"))
        a, b = every_stretch([i not in gone for i in range(len(passage))])
        expected[(k, int(passage is long))] = (30 + a, a, b - a, sum(i not in gone for i in range(a, b)))
    assert overlaps(documents(rows), items) == expected
