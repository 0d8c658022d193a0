"""Languages: Viterbi against all labellings, held-out accuracy, mixed texts."""

from itertools import product

import numpy as np

from plumefeed.llm import language_spans as ls

SAMPLES = {
    "en": "the quick brown fox jumps over the lazy dog and they think that this is all there is",
    "de": "der schnelle braune fuchs springt über den faulen hund und sie denken dass das alles ist",
    "ru": "быстрая лиса прыгает через ленивую собаку и они думают что это всё что здесь есть",
    "el": "η γρήγορη αλεπού πηδά πάνω από το τεμπέλικο σκυλί και νομίζουν ότι αυτό είναι όλο",
}


def labelled(documents):
    rows = [(10 * i + k, t, lang) for k, (lang, t) in enumerate(SAMPLES.items()) for i in range(20)]
    return documents(rows)


def test_viterbi_equals_all_labellings():
    rng = np.random.default_rng(2)
    sizes = [0, 1, 5, 3, 0, 6, 2]
    first = np.concatenate([[0], np.cumsum(sizes)])
    for penalty in (0.0, 0.7, 3.0):
        scores = rng.normal(0, 1, (first[-1], 3)).astype(np.float32)
        got = ls.viterbi(scores, first, penalty)
        for a, b in zip(first[:-1], first[1:]):
            worth = lambda path: sum(scores[a + i, s] for i, s in enumerate(path)) - penalty * sum(
                x != y for x, y in zip(path, path[1:])
            )
            best = max(worth(p) for p in product(range(3), repeat=b - a))
            assert abs(worth(got[a:b].tolist()) - best) < 1e-4


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('sf0.001', 'sf0.01')}/documents.parquet")
    spans = ls.label_spans(docs, ls.learn(docs))
    rows = spans.join(docs, "doc_id").where(ls.held_out()).select("lang", "lang_pred", "score").collect()
    right = sum(r.lang == r.lang_pred for r in rows) / len(rows)
    assert len(rows) > 100 and right >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_mixed_text_and_scripts(documents):
    model = ls.learn(labelled(documents))
    assert model.languages == ("de", "el", "en", "ru")
    text = f"😀 {SAMPLES['en']}. {SAMPLES['ru']}! 123 {SAMPLES['de']}"
    row = ls.label_spans(documents([(1, text, None)]), model).first()
    assert [s["lang"] for s in row.spans] == ["en", "ru", "de"]
    inside = [text[s["start"] : s["end"]] for s in row.spans]
    assert inside[0].endswith(SAMPLES["en"]) and SAMPLES["ru"] in inside[1] and inside[2].endswith("ist")
    assert row.lang_pred in SAMPLES and 0 < row.score < 1
    # A script that one language uses alone decides, whatever the words.
    other = ls.label_spans(documents([(2, "ωωω ξξξ", None), (3, "漢字", None)]), model).collect()
    assert {r.doc_id: r.lang_pred for r in other}[2] == "el"


def test_odd_rows(odd, odd_rows, nothing, documents):
    model = ls.learn(labelled(documents))
    rows = ls.label_spans(odd, model).collect()
    assert len(rows) == len(odd_rows)
    by_id = {r.doc_id: r for r in rows if r.doc_id}
    for i in (2, 3, 4):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].spans) == ("und", 0.0, [])
    assert ls.label_spans(documents([(1, "123 … 4", "en")]), model).first().lang_pred == "und"
    assert ls.label_spans(nothing, model).collect() == []
    unlearned = ls.learn(nothing)
    assert unlearned.languages == ()
    assert {r.lang_pred for r in ls.label_spans(odd, unlearned).collect()} == {"und"}


def test_nothing_is_learned_from_held_out_rows(documents):
    import zlib

    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert ls.learn(documents([(i, SAMPLES["en"], "en") for i in ids])).languages == ()
