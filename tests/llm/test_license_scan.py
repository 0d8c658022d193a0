"""License notices; the registered query is held against SQL in test_llm_queries."""

import random
import re

import duckdb

from plumefeed.llm import license_scan as ls
from plumefeed.llm.queries import license_sql


def brute(text, templates, phrases, threshold):
    """Every template against every block, every phrase at every place."""
    words = re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [
        (i, label)
        for p, label in phrases
        for i in range(len(words))
        if words[i : i + len(p.split())] == p.split()
    ]
    best, labels = 0.0, {label for _, label in places}
    for label, template in templates:
        step = ls.step_for(template)
        for start in range(0, max(1, len(words)), step):
            block = set(words[start : start + 2 * step])
            share = len(block & set(template.split())) / len(set(template.split()))
            if share >= threshold - 1e-9:
                labels.add(label)
                best = max(best, share)
    starts = [i for i, _ in places]
    return (
        len(words),
        len(places),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted({label for _, label in places})),
        ",".join(sorted(labels)),
        1.0 if places else best,
    )


def test_equals_every_block(documents):
    rng = random.Random(6)
    common = "the of and in software license use this free work x1 x2 x3".split()
    rows = []
    for i in range(150):
        words = [rng.choice(common) for _ in range(rng.randrange(200))]
        for _, template in rng.sample(ls.TEMPLATES, rng.randrange(3)):
            kept = [w for w in template.split() if rng.random() < rng.choice([1, 0.9, 0.75])]
            at = rng.randrange(len(words) + 1)
            words[at:at] = kept
        for phrase, _ in rng.sample(ls.PHRASES, rng.randrange(2)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = phrase.split() * rng.choice([1, 2])
        text = "".join(w + rng.choice([" ", ", ", "\n", " - "]) for w in words)
        rows.append((i, rng.choice([str, str.upper, str.title])(text), "en"))
    for threshold in (0.8, 0.6):
        got = {r.doc_id: tuple(r)[1:] for r in ls.scan_licenses(documents(rows), threshold=threshold).collect()}
        assert got == {i: brute(t, ls.TEMPLATES, ls.PHRASES, threshold) for i, t, _ in rows}


def test_odd_rows(odd, odd_rows, nothing, documents):
    rows = ls.scan_licenses(odd).collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        if r.doc_id in (2, 3, 4):
            assert tuple(r)[1:] == (0, 0, None, None, "", "", 0.0)
    assert ls.scan_licenses(nothing).collect() == []
    plain = ls.scan_licenses(odd, templates=())
    assert {r.labels for r in plain.collect()} == {""}
    one = ls.scan_licenses(documents([(1, "CC BY-NC CC by nc", "en")])).first()
    assert (one.n_base, one.first_word, one.last_word, one.labels) == (2, 0, 3, "cc-by-nc")


def test_null_and_repeated_ids_and_long_templates_equal_sql(documents):
    """Each row has the labels of its own text; a template of any length is found whole."""
    mit = dict(ls.TEMPLATES)["mit"]
    long = " ".join(f"term{i}" for i in range(120))
    sixty = " ".join(f"word{i}" for i in range(60))
    templates = (*ls.TEMPLATES, ("long", long), ("sixty", sixty))
    filler = " ".join(f"f{i}" for i in range(16))
    rows = [
        (None, mit, "en"),
        (None, "nothing here at all", "en"),
        (7, "plain words", "en"),
        (7, f"{mit} under the MIT license", "en"),
        (8, long, "en"),
        (9, f"{filler} {sixty} {filler}", "en"),
        (10, f"{filler * 5} {long} and more", "en"),
        (11, " ".join(long.split()[:90]), "en"),
        (12, "term0 " * 200, "en"),
        (13, "\u212apache license version 2", "en"),
        (14, "APACHE License, Version 2", "en"),
    ]
    docs = documents(rows)
    got = sorted((tuple(r) for r in ls.scan_licenses(docs, templates).collect()), key=repr)
    db = duckdb.connect()
    db.register("documents", docs.select("doc_id", "text").toArrow())
    columns = "doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score"
    expected = db.execute(f"SELECT {columns} FROM ({license_sql(templates)})").fetchall()
    assert got == sorted(expected, key=repr)
    labels = [(r[0], r[6], r[7]) for r in got]
    assert {(None, "mit", 1.0), (None, "", 0.0), (7, "", 0.0), (8, "long", 1.0), (9, "sixty", 1.0)} <= set(labels)
    assert {(10, "long", 1.0), (11, "", 0.0), (12, "", 0.0), (13, "", 0.0), (14, "apache-2", 1.0)} <= set(labels)
