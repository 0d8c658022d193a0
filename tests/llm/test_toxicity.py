"""Toxicity on planted words, their unseen misspellings, and labelled documents."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from plumefeed.llm import toxicity as tx

LABELS = "doc_id long, quality int, toxic int, text string"


@pytest.fixture(scope="module")
def planted(spark, documents):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(rng.randrange(2, 8)))
    rows, labels = [], []
    for i in range(300):
        words = [word() for _ in range(rng.randrange(5, 200))]
        toxic = i % 3 == 0
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(["vyzquort", "Thrupsky", "wostwurz"]))
        rows.append((i, " ".join(words), "en"))
        labels.append((i, 1, int(toxic), "x"))
    labels += [(None, 1, 1, "x"), (5000, 1, 1, "x"), (1, 1, None, "x")]
    return documents(rows), spark.createDataFrame(labels, LABELS), rows


def test_planted_words_and_misspellings(planted, documents):
    docs, labels, rows = planted
    model = tx.learn(docs, labels)
    got = {r.doc_id: r.predicted for r in tx.score(docs, model).collect()}
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 30
    assert sum(got[i] == (i % 3 == 0) for i in held) / len(held) >= 0.95
    clean = rows[1][1]
    new = documents([(1, "vyzquorrt", "en"), (2, "Thrupskies!", "en"), (3, "wostwurzeln", "en"), (4, clean, "en")])
    assert {r.doc_id: r.predicted for r in tx.score(new, model).collect()} == {1: 1, 2: 1, 3: 1, 4: 0}


def test_same_model_each_time(planted):
    docs, labels, _ = planted
    assert tx.learn(docs, labels) == tx.learn(docs.repartition(5), labels)


def test_odd_rows(planted, spark, odd, odd_rows, nothing):
    docs, labels, _ = planted
    model = tx.learn(docs, labels)
    rows = tx.score(odd, model).collect()
    assert len(rows) == len(odd_rows)
    assert all(0 <= r.score < 0.5 and r.predicted == 0 for r in rows if r.doc_id in (2, 3, 4))
    assert tx.score(nothing, model).collect() == []
    left = tx.drop_toxic(odd, labels)
    assert left.columns == odd.columns
    assert {r.score for r in left.collect()} == {"x"}
    assert tx.drop_toxic(nothing, labels).collect() == []


def test_labels_of_one_kind_or_none(planted):
    docs, labels, _ = planted
    none = tx.score(docs, tx.learn(docs, labels.limit(0)))
    assert none.agg(F.max("score")).first()[0] < 0.01
    calm = tx.score(docs, tx.learn(docs, labels.where("toxic = 0")))
    assert calm.agg(F.max("score")).first()[0] < 0.01
    upset = tx.score(docs, tx.learn(docs, labels.where("toxic = 1")))
    assert upset.agg(F.min("score")).first()[0] > 0.99


def test_held_out_labels(spark, sf):
    big = sf.replace("sf0.001", "sf0.1")
    docs, labels = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    scored = tx.score(docs.select("doc_id", "text"), tx.learn(docs, labels))
    rows = scored.join(labels, "doc_id").where(tx.held_out()).select("toxic", "predicted").collect()
    toxic = [r.predicted for r in rows if r.toxic]
    calm = [r.predicted for r in rows if not r.toxic]
    # Some labels of these data fit no word of their text.
    assert sum(toxic) / len(toxic) >= 0.75
    assert sum(calm) / len(calm) <= 0.06


def test_workers_give_back_what_tasks_held(monkeypatch):
    """A worker that waits for its next task keeps nothing of the last one, ended early or not."""
    from plumefeed.llm import textops

    calls = []
    monkeypatch.setattr(textops, "give_back", lambda: calls.append(1))
    run = textops._giving_back(lambda batches: (2 * b for b in batches))
    assert list(run(iter([1, 2]))) == [2, 4] and calls == [1]
    early = run(iter([1, 2]))
    assert next(early) == 2
    early.close()
    assert calls == [1, 1]


def test_giving_back_works_here():
    from plumefeed.llm import textops

    textops.give_back()
