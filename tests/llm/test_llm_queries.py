"""The registered queries against their SQL, and the pipeline against plain Python."""

import os
import re

import duckdb
import pytest

import corpus_pipeline
from plumefeed.llm import queries, toxicity

from test_minhash import brute
from test_secret_scan import base_spans


@pytest.fixture(scope="module")
def db(sf):
    found = duckdb.connect()
    for name in os.listdir(sf):
        found.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{name}'")
    return found


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, db, sf, name):
    df = queries.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    expected = db.execute(f"SELECT {', '.join(columns)} FROM ({queries.ORACLE[name]})").fetchall()
    assert got and got == sorted(expected, key=repr)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_query_gives_rows(spark, sf, name):
    df = queries.QUERIES[name](spark, sf)
    assert "doc_id" in df.columns and df.count() > 0


def test_pipeline_equals_plain_python(spark, sf):
    """Toxic documents by the classifier's own scores, all other stages by brute force."""
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score(docs, toxicity.learn(docs, labels)).collect()
    calm = {r.doc_id: r.text or "" for r in scored if not r.predicted}
    assert 0 < len(calm) < len(scored)
    single = [i for i, (_, _, kept) in brute(calm.items(), 5).items() if kept]
    assert len(single) < len(calm)

    words = lambda t: re.findall("[0-9a-z\x80-\U0010ffff]+", t.lower())
    grams = set()
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        w = words(r.text)
        grams |= {tuple(w[k : k + 11]) for k in range(len(w) - 10)}
    leaked = set()
    for i in single:
        w = words(calm[i])
        if any(tuple(w[k : k + 11]) in grams for k in range(len(w) - 10)):
            leaked.add(i)
    assert leaked
    rows = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, sf).collect()}
    assert set(rows) == set(single) - leaked
    for i, n in rows.items():
        text = calm[i]
        if not base_spans(text):
            assert n == len(text.split())


def test_stages_keep_columns_and_take_odd_rows(spark, sf, odd, nothing):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "decontamination", "secrets", "packing",
    ]
    for docs in (odd, nothing):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.columns == docs.columns
            assert out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == docs.count()
