"""Languages of mixed texts: scripts narrow the candidates, Viterbi labels the spans.

Every word gets a score in each language from the character runs seen in labelled texts.
Languages that do not use the word's script are out. Viterbi then finds the best labelling
of the whole text, with a fixed penalty for each change of language.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import materialize
from .textops import (
    Words,
    ascii_words,
    bounded_sample,
    fetch,
    held_out,
    map_rows,
    marked,
    slices,
    text_buffers,
    words_of,
)

UNKNOWN = "und"
BITS = 16
RUNS = (0, 1, 2, 3, 4)
# Bounds of what is learned from: documents per language, bytes of one document, languages.
PER_LANGUAGE, MAX_BYTES, MAX_LANGUAGES = 1000, 200_000, 500
SMOOTHING = 0.1
SWITCH = 6.0
# The score of a language whose script a word is not written in.
OUT = -1000.0
# A language uses a script if at least this share of its words is in it.
SCRIPT_SHARE = 0.01
# Text whose spans are found at a time.
GROUP_BYTES = 8 << 20

# First code point of runs of blocks, and the script of their letters.
SCRIPT_STARTS = (
    (0x0000, "Latin"),
    (0x0370, "Greek"),
    (0x0400, "Cyrillic"),
    (0x0530, "Armenian"),
    (0x0590, "Hebrew"),
    (0x0600, "Arabic"),
    (0x0900, "Devanagari"),
    (0x0980, "Bengali"),
    (0x0A00, "Gurmukhi"),
    (0x0A80, "Gujarati"),
    (0x0B00, "Oriya"),
    (0x0B80, "Tamil"),
    (0x0C00, "Telugu"),
    (0x0C80, "Kannada"),
    (0x0D00, "Malayalam"),
    (0x0D80, "Sinhala"),
    (0x0E00, "Thai"),
    (0x0E80, "Lao"),
    (0x0F00, "Tibetan"),
    (0x1000, "Myanmar"),
    (0x10A0, "Georgian"),
    (0x1100, "Hangul"),
    (0x1200, "Ethiopic"),
    (0x1E00, "Latin"),
    (0x1F00, "Greek"),
    (0x2000, "Other"),
    (0x3040, "Kana"),
    (0x3130, "Hangul"),
    (0x3190, "Han"),
    (0xA000, "Other"),
    (0xAC00, "Hangul"),
    (0xD7B0, "Other"),
    (0xF900, "Han"),
    (0xFB00, "Other"),
    (0x20000, "Han"),
)
SCRIPTS = sorted({s for _, s in SCRIPT_STARTS})
_STARTS = [a for a, _ in SCRIPT_STARTS]
_NUMBERS = [SCRIPTS.index(s) for _, s in SCRIPT_STARTS]


@dataclass(frozen=True)
class LanguageModel:
    """Log-probability of each hashed run in each language, and the scripts of each."""

    languages: tuple[str, ...]
    runs: np.ndarray  # 2**BITS x languages
    uses: np.ndarray  # scripts x languages


def _scripts(words: Words, pick: np.ndarray) -> np.ndarray:
    """Script number of each picked word, by its first letter; -1 without a letter.

    A word with an ASCII letter is Latin.
    """
    out = np.full(len(pick), SCRIPTS.index("Latin"))
    lower = words.data | 0x20
    letters = np.zeros(len(words.data) + 1, np.int64)
    np.cumsum((lower >= 0x61) & (lower <= 0x7A) & (words.data < 0x80), out=letters[1:])
    begin, end = words.start[pick], words.end[pick]
    for i in np.flatnonzero(letters[end] == letters[begin]).tolist():
        text = words.data[begin[i] : end[i]].tobytes().decode("utf-8")
        first = next((c for c in text if c.isalpha()), None)
        out[i] = -1 if first is None else _NUMBERS[bisect_right(_STARTS, ord(first)) - 1]
    return out


def learn(docs: DataFrame, may_learn: Column | None = None) -> LanguageModel:
    """Runs and scripts of each language from a bounded sample of labelled texts.

    About ``PER_LANGUAGE`` documents of each non-null ``lang``, none over ``MAX_BYTES``.
    Each task adds up its texts per language, and only one row of fixed size per language
    comes to the driver. More than ``MAX_LANGUAGES`` languages are an error.
    """
    allowed = ~held_out() if may_learn is None else may_learn
    known = docs.where("doc_id is not null and lang is not null").where(allowed)
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").alias("__lang"))
    chosen = bounded_sample(known.distinct(), "__lang", "doc_id", PER_LANGUAGE)
    chosen = materialize(chosen, "labelled")
    own = docs.where(allowed & (F.octet_length("text") <= MAX_BYTES))
    texts = fetch(own.select("doc_id", "text", "lang"), chosen).where("lang = __lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[str, np.ndarray] = {}
        used: dict[str, np.ndarray] = {}
        for batch, text in slices(batches):
            names = np.array(batch.column("lang").to_pylist(), object)
            for name in dict.fromkeys(names):
                words = words_of(text.take(pa.array(np.flatnonzero(names == name))), ascii_words())
                _, sample, times = np.unique(words.hashes, return_index=True, return_counts=True)
                total = runs.setdefault(name, np.zeros(1 << BITS))
                near = marked(words, sample)
                for n in RUNS:
                    bucket, owner = near.grams(n, BITS)
                    total += np.bincount(bucket, times[owner], 1 << BITS)
                script = _scripts(words, sample)
                seen = used.setdefault(name, np.zeros(len(SCRIPTS)))
                seen += np.bincount(script[script >= 0], times[script >= 0], len(SCRIPTS))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(runs), pa.string()),
                pa.array([v.tobytes() for v in runs.values()], pa.binary()),
                pa.array([v.tobytes() for v in used.values()], pa.binary()),
            ],
            names=["lang", "runs", "used"],
        )

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = None
        for batch in batches:
            for row in batch.to_pylist():
                parts = [np.frombuffer(row[c]) for c in ("runs", "used")]
                totals = parts if totals is None else [a + b for a, b in zip(totals, parts)]
        columns = [pa.array([key[0].as_py()]), *(pa.array([t.tobytes()], pa.binary()) for t in totals)]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "runs", "used"])

    schema = "lang string, runs binary, used binary"
    partial = map_rows(texts.select("lang", "text"), count, schema)
    rows = partial.groupBy("lang").applyInArrow(add, schema).limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    rows.sort(key=lambda r: r.lang)
    if not rows:
        return LanguageModel((), np.zeros((1 << BITS, 0), np.float32), np.zeros((len(SCRIPTS), 0), bool))
    runs = np.stack([np.frombuffer(r.runs) for r in rows], axis=1) + SMOOTHING
    used = np.stack([np.frombuffer(r.used) for r in rows], axis=1)
    uses = used >= SCRIPT_SHARE * np.maximum(used.sum(axis=0), 1)
    logs = np.log(runs / runs.sum(axis=0))
    return LanguageModel(tuple(r.lang for r in rows), logs.astype(np.float32), uses & (used > 0))


def word_scores(words: Words, model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Score of every word in each language, and whether it has a letter.

    Words without letters say nothing and go with their neighbours.
    """
    _, sample, number = np.unique(words.hashes, return_index=True, return_inverse=True)
    script = _scripts(words, sample)
    near = marked(words, sample)
    total = np.zeros((len(sample), len(model.languages)), np.float32)
    for n in RUNS:
        bucket, owner = near.grams(n, BITS)
        for k in range(len(model.languages)):
            total[:, k] += np.bincount(owner, model.runs[bucket, k], len(sample))
    # Runs of several lengths tell the same thing several times.
    total /= len(RUNS)
    # A script that no language uses rules none out.
    out = ~model.uses[script] & model.uses[script].any(axis=1, keepdims=True)
    total[out & (script >= 0)[:, None]] = OUT
    total[script < 0] = 0
    return total[number], (script >= 0)[number]


def viterbi(scores: np.ndarray, first: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language of every word; all texts walk side by side.

    Text i has the words first[i]:first[i+1]. Ties go to the first language, and to staying.
    """
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    order = order[size[order] > 0]
    begin, size = first[order], size[order]
    stay = np.ones(scores.shape, bool)
    came = np.zeros(len(scores), np.int16)
    out = np.zeros(len(scores), np.int16)
    if not len(order):
        return out
    longest = int(size[0])
    # Texts still walking at each step; they are ordered by length.
    alive = np.searchsorted(-size, -np.arange(1, longest + 1), "right")
    best = scores[begin].copy()
    final = np.empty(len(order), np.int16)
    for step in range(1, longest):
        n, before = alive[step], alive[step - 1]
        if n < before:
            final[n:before] = best[n:before].argmax(axis=1)
            best = best[:n]
        at = begin[:n] + step
        top = best.argmax(axis=1)
        height = best[np.arange(n), top]
        jump = (height - switch)[:, None]
        stay[at] = best >= jump
        came[at] = top
        best = np.maximum(best, jump) - height[:, None] + scores[at]
    final[: len(best)] = best.argmax(axis=1)
    state = np.empty(0, np.int16)
    for step in range(longest - 1, -1, -1):
        n = alive[step]
        state = np.concatenate([state, final[len(state) : n]])
        at = begin[:n] + step
        out[at] = state
        state = np.where(stay[at, state], state, came[at]).astype(np.int16)
    return out


def label_spans(docs: DataFrame, model: LanguageModel, switch: float = SWITCH) -> DataFrame:
    """``doc_id, lang_pred, score, spans``: the language of most letters, its share, all spans.

    ``spans`` is an array of ``start, end, lang`` in code points: from the first to the last
    word of each stretch of one language. ``score`` is the share of the text's bytes in words
    that is in ``lang_pred``. Null and empty texts, and those without letters, are ``und``
    with score 0 and no spans, and so is everything if nothing was learned.

    Every row gives a row, also with a null or repeated id; other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.runs, model.uses))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = LanguageModel(*sent.value)
        names = np.array([*known.languages, UNKNOWN], object)
        for batch, group in slices(batches, size=GROUP_BYTES):
            pieces = list(slices(iter([pa.RecordBatch.from_arrays([group], names=["text"])])))
            all_words = [words_of(text, ascii_words()) for _, text in pieces]
            scored = [word_scores(w, known) for w in all_words]
            scores = np.concatenate([s for s, _ in scored])
            letters = np.concatenate([has for _, has in scored])
            size = np.concatenate([w.end - w.start for w in all_words])
            first = np.concatenate([[0], np.cumsum(np.concatenate([w.counts() for w in all_words]))])
            width = len(known.languages)
            label = viterbi(scores, first, switch) if width else np.zeros(len(scores), np.int16)
            row = np.repeat(np.arange(len(group)), np.diff(first))
            weight = np.zeros((len(group), max(width, 1)))
            np.add.at(weight, (row, label), np.where(letters, size, 0) if width else 0)
            top = weight.argmax(axis=1)
            whole = weight.sum(axis=1)
            share = weight[np.arange(len(group)), top] / np.maximum(whole, 1)
            pick = np.where(whole > 0, top, width)

            begin, end = [], []
            for w, (_, text) in zip(all_words, pieces):
                raw, at = text_buffers(text)
                points = np.zeros(len(raw) + 1, np.int64)
                np.cumsum((raw & 0xC0) != 0x80, out=points[1:])
                base = points[np.repeat(at[:-1], w.counts())]
                begin.append(points[w.start] - base)
                end.append(points[w.end] - base)
            begin, end = np.concatenate(begin), np.concatenate(end)
            new = np.ones(len(label), bool)
            new[1:] = (label[1:] != label[:-1]) | (row[1:] != row[:-1])
            new &= whole[row] > 0
            heads = np.flatnonzero(new)
            inside = np.flatnonzero(whole[row] > 0)
            last = np.append(heads[1:], len(label))
            # The next stretch may begin after texts without letters.
            stops = inside[np.searchsorted(inside, last) - 1] if len(heads) else heads
            spans = pa.StructArray.from_arrays(
                [
                    pa.array(begin[heads], pa.int32()),
                    pa.array(end[stops], pa.int32()),
                    pa.array(names[label[heads]], pa.string()),
                ],
                names=["start", "end", "lang"],
            )
            at = np.searchsorted(row[heads], np.arange(len(group) + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(names[pick], pa.string()),
                    pa.array(np.where(whole > 0, share, 0.0)),
                    pa.ListArray.from_arrays(pa.array(at, pa.int32()), spans),
                ],
                names=["doc_id", "lang_pred", "score", "spans"],
            )

    schema = (
        "doc_id long, lang_pred string, score double, "
        "spans array<struct<start: int, end: int, lang: string>>"
    )
    return map_rows(docs.select("doc_id", "text"), run, schema)
