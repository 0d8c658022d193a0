"""Perplexities against a plain Kneser-Ney model, and thresholds."""

import math
import os
import random
import zlib
from collections import Counter, defaultdict

import pytest

from plumefeed.llm import kneser_ney as kn


def brute(trusted, texts, order=kn.ORDER):
    """Interpolated modified Kneser-Ney over characters, by dictionaries."""
    pad = (None,) * (order - 1)
    grams = lambda t: [(*pad, *t)[i : i + order] for i in range(len(t))]
    counts = {order: Counter(g for t in trusted for g in grams(t))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    pulls, totals, spare = {}, {}, {}
    for k, table in counts.items():
        n = Counter(table.values())
        share = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
        pulls[k] = [
            min(max(i - (i + 1) * share * n[i + 1] / n[i], 0.1), i) if n[i] and n[i + 1] else 0.5 * i
            for i in (1, 2, 3)
        ]
        totals[k], spare[k] = Counter(), defaultdict(float)
        for g, c in table.items():
            totals[k][g[:-1]] += c
            spare[k][g[:-1]] += pulls[k][min(c, 3) - 1]

    def p(g):
        k = len(g)
        if not k:
            return 1 / (len(counts[1]) + 1)
        low, total = p(g[1:]), totals[k][g[:-1]]
        if not total:
            return low
        c = counts[k][g]
        own = (c - pulls[k][min(c, 3) - 1]) / total if c else 0
        return own + spare[k][g[:-1]] / total * low

    return {
        i: math.exp(-sum(math.log(p(g)) for g in grams(t)) / len(t)) if t else None
        for i, t in texts.items()
    }


def left_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    words = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randrange(2, 7))) for _ in range(60)]
    good = {i: " ".join(rng.choice(words) for _ in range(60)) + " é漢😀"[: rng.randrange(4)] for i in range(60)}
    bad = {100 + i: "".join(rng.choice("xyz%&# 0123") for _ in range(200)) for i in range(10)}
    return good, bad


def test_equals_plain_model(spark, documents, corpus, monkeypatch):
    good, bad = corpus
    texts = {**good, **bad, 200: "", 201: None, 202: "a"}
    trusted = list(range(0, 60, 2))
    docs = documents([(i, t, "en") for i, t in texts.items()]).repartition(3)
    ids = spark.createDataFrame([(i,) for i in trusted] + [(None,), (999,)], "doc_id long")
    got = {r.doc_id: r.perplexity for r in kn.perplexities(docs, ids).collect()}
    expected = brute([good[i] for i in trusted], texts)
    assert got.keys() == expected.keys()
    for i, p in expected.items():
        assert got[i] == p if p is None else got[i] == pytest.approx(p, rel=1e-9)


def test_thresholds_by_language(spark, documents, corpus):
    good, bad = corpus
    # Some texts again under ids that are left out, enough for a threshold of each language.
    ids_out = [i for i in range(1000, 2000) if left_out(i)][:50]
    good = {**good, **{i: good[n % 60][::-1] for n, i in enumerate(ids_out)}}
    place = {i: n for n, i in enumerate(good)}
    rows = [(i, t, "en" if place[i] % 2 else None) for i, t in good.items()] + [(i, t, "en") for i, t in bad.items()]
    ids = spark.createDataFrame([(i,) for i in good], "doc_id long")
    judged = kn.judge_quality(documents(rows), ids).collect()
    assert {r.doc_id for r in judged if not r.kept} >= set(bad)
    lost = [r.doc_id for r in judged if not r.kept and r.doc_id in good]
    assert len(lost) <= 4
    assert len({r.threshold for r in judged if r.lang == "en"}) == 1
    assert len({r.threshold for r in judged}) == 2


def test_odd_rows(spark, odd, odd_rows, nothing):
    ids = spark.createDataFrame([(1,), (5,), (9,)], "doc_id long")
    assert not left_out(1) or not left_out(5) or not left_out(9)
    rows = kn.judge_quality(odd, ids).collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        if r.doc_id in (2, 3):
            assert (r.n_chars, r.perplexity, r.kept) == (0, None, False)
    none = ids.limit(0)
    untaught = kn.judge_quality(odd, none).collect()
    assert all(r.threshold is None and r.kept == (r.n_chars > 0) for r in untaught)
    assert kn.judge_quality(nothing, ids).collect() == []


def test_threshold_is_the_quantile_itself(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    quality = {r.doc_id: r.quality for r in labels.collect()}
    rows = kn.judge_quality(docs, labels.where("quality = 1")).collect()
    good = defaultdict(list)
    for r in rows:
        if quality.get(r.doc_id) == 1 and r.perplexity is not None and left_out(r.doc_id):
            good[r.lang].append(r.perplexity)
    everyone = sorted(p for of_lang in good.values() for p in of_lang)
    for r in rows:
        trusted = sorted(good[r.lang]) if len(good[r.lang]) >= 20 else everyone
        assert r.threshold == trusted[math.ceil(0.99 * len(trusted)) - 1]
        assert r.kept == (r.perplexity is not None and r.perplexity <= r.threshold)


def test_recall_on_poor_texts(spark):
    sf = "/root/testdata/sf0.01"
    if not os.path.isdir(sf):
        pytest.skip("test tables are absent")
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    judged = kn.judge_quality(docs, labels.where("quality = 1")).join(labels, "doc_id")
    poor = [r.kept for r in judged.where("quality = 0").collect()]
    assert len(poor) > 50 and sum(poor) <= 0.1 * len(poor)


def test_characters_beyond_the_first_32767_are_told_apart(spark, documents):
    rng = random.Random(3)
    syllables = [chr(c) for c in rng.sample(range(0xAC00, 0xD7A3), 40)] + ["😀", "🎉", "\U0010ffff"]
    common = ["".join(rng.choice(syllables) for _ in range(3)) for _ in range(12)]
    texts = {i: " ".join(rng.choice(common) for _ in range(30)) for i in range(20)}
    texts[90] = "".join(chr(rng.randrange(0xAC00, 0xD7A3)) for _ in range(120))
    texts[91] = "\x01\x02" * 9
    ids = spark.createDataFrame([(i,) for i in range(10)], "doc_id long")
    docs = documents([(i, t, "ko") for i, t in texts.items()])
    got = {r.doc_id: r.perplexity for r in kn.perplexities(docs, ids).collect()}
    for i, p in brute([texts[i] for i in range(10)], texts).items():
        assert got[i] == pytest.approx(p, rel=1e-9)
    assert got[90] > 10 * max(got[i] for i in range(20))
