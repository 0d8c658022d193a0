"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its character runs and of itself, a passage of
``PASSAGE`` words the mean of its words, and a linear softmax over the two classes scores
it. A text counts as toxic as its worst passage, so a few bad words in a long text are
found. Misspelt and inflected words share their runs with the words that were seen.
"""

from __future__ import annotations

from collections.abc import Iterator

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
    words_of,
)

BITS, DIM, PASSAGE = 17, 8, 6
RUNS = (0, 3, 4, 5)
# Bounds of what is learned from: documents per label, bytes of one document.
PER_LABEL, MAX_BYTES = 1500, 200_000
STEPS, MEAN_STEPS, RATE = 80, 5, 0.3


def _distinct(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """A sample of each distinct word, and every word's number among them."""
    _, sample, number = np.unique(words.hashes, return_index=True, return_inverse=True)
    return sample, number


def _passages(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each passage begins, and where the passages of each text begin."""
    begins, heads = [], np.zeros(len(first), np.int64)
    for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        begins.append(np.arange(a, b, PASSAGE))
        heads[i + 1] = heads[i] + len(begins[-1])
    return np.concatenate(begins) if begins else np.empty(0, np.int64), heads


def _train(texts: pa.Array, toxic: np.ndarray) -> tuple[np.ndarray, float]:
    """Score of each bucket and the bias, by full-batch steps down the logistic loss."""
    words = words_of(texts, ascii_words())
    full = np.flatnonzero(words.counts() > 0)
    toxic = toxic[full].astype(float)
    if not len(full) or toxic.min() == toxic.max():
        share = toxic.mean() if len(full) else 0.0
        return np.zeros(1 << BITS, np.float32), 20.0 if share == 1.0 else -20.0
    sample, number = _distinct(words)
    parts = [marked(words, sample).grams(n, BITS) for n in RUNS]
    owner = np.concatenate([p[1] for p in parts])
    order = np.argsort(owner, kind="stable")
    bucket = np.concatenate([p[0] for p in parts])[order]
    size = np.bincount(owner, minlength=len(sample))
    head = np.concatenate([[0], np.cumsum(size)[:-1]])
    begins, heads = _passages(words.first)
    length = np.diff(np.append(begins, len(words.hashes)))
    heads = heads[full]
    passages = np.diff(np.append(heads, len(begins)))
    doc_of = np.repeat(np.arange(len(full)), passages)
    passage_of = np.repeat(np.arange(len(begins)), length)

    rng = np.random.default_rng(5)
    vectors = rng.normal(0, 0.1, (1 << BITS, DIM))
    weights = rng.normal(0, 0.5, (DIM, 2))
    bias = np.zeros(2)
    balance = np.where(toxic == 1, 0.5 / toxic.sum(), 0.5 / (1 - toxic).sum())
    speed = np.zeros_like(vectors)
    for step in range(1, STEPS + 1):
        direction = weights[:, 1] - weights[:, 0]
        value = vectors @ direction
        word = np.add.reduceat(value[bucket], head) / size
        passage = np.add.reduceat(word[number], begins) / length
        if step <= MEAN_STEPS:
            share = (1 / passages)[doc_of]
        else:
            worst = np.maximum.reduceat(passage, heads)[doc_of]
            share = (passage == worst).astype(float)
            share /= np.add.reduceat(share, heads)[doc_of]
        logit = np.add.reduceat(passage * share, heads) + bias[1] - bias[0]
        slope = balance * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - toxic)
        # Back to passages, words and buckets.
        used = np.flatnonzero(share)
        pull = np.zeros(len(begins))
        pull[used] = slope[doc_of[used]] * share[used] / length[used]
        per_word = np.bincount(number, pull[passage_of], len(sample)) / size
        picked = np.repeat(per_word != 0, size)
        per_bucket = np.bincount(bucket[picked], np.repeat(per_word, size)[picked], 1 << BITS)
        turn = vectors.T @ per_bucket
        # The largest slope sets the step, so runs that many documents share move first and
        # those of a single document hardly at all.
        speed *= 0.8
        speed += np.outer(per_bucket, direction) / (np.abs(per_bucket).max() + 1e-12)
        vectors -= RATE * speed
        weights -= RATE * np.stack([-turn, turn], axis=1)
        bias -= RATE * np.array([-slope.sum(), slope.sum()])
    value = vectors @ (weights[:, 1] - weights[:, 0])
    return value.astype(np.float32), float(bias[1] - bias[0])


def learn(docs: DataFrame, labels: DataFrame, may_learn: Column | None = None) -> tuple[bytes, float]:
    """Bucket scores and bias from a bounded sample of labelled documents.

    About ``PER_LABEL`` documents of either label, none over ``MAX_BYTES``, are read by one
    task; the model it returns has a fixed size. A document with two labels is toxic if one
    says so. Without labelled rows every score is near 0; with one label only, near that.
    """
    allowed = ~held_out() if may_learn is None else may_learn
    known = labels.where("doc_id is not null and toxic is not null").where(allowed)
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("toxic") > 0).cast("int")).alias("__toxic")
    )
    chosen = materialize(bounded_sample(known, "__toxic", "doc_id", PER_LABEL), "labelled")
    texts = fetch(docs.select("doc_id", "text").where(F.octet_length("text") <= MAX_BYTES), chosen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        rows = pa.Table.from_batches(held).sort_by([("doc_id", "ascending"), ("text", "ascending")])
        text = rows.column("text").combine_chunks().cast(pa.large_string())
        toxic = rows.column("__toxic").to_numpy()
        value, bias = _train(text, toxic)
        yield pa.RecordBatch.from_arrays(
            [pa.array([value.tobytes()], pa.binary()), pa.array([bias])], names=["value", "bias"]
        )

    sample = texts.select("doc_id", "text", F.col("__toxic")).repartition(1)
    model = map_rows(sample, run, "value binary, bias double").collect()
    return (bytes(model[0].value), model[0].bias) if model else (bytes(4 << BITS), -20.0)


def score(
    docs: DataFrame, model: tuple[bytes, float], names: tuple[str, str] = ("score", "predicted")
) -> DataFrame:
    """``docs`` with a score (0 to 1, of the worst passage) and a prediction (0 or 1).

    Null and empty texts, and those without words, get the score of the bias alone, below
    0.5. Every row gives a row. Columns of the input with the two ``names`` are replaced, all
    others kept.
    """
    docs = docs.drop(*names)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, bias = sent.value
        value = np.frombuffer(raw, np.float32)
        for batch, text in slices(batches):
            words = words_of(text, ascii_words())
            logit = np.full(len(text), min(bias, -1e-6))
            if len(words.hashes):
                sample, number = _distinct(words)
                near = marked(words, sample)
                total, size = np.zeros(len(sample)), np.zeros(len(sample))
                for n in RUNS:
                    bucket, owner = near.grams(n, BITS)
                    total += np.bincount(owner, value[bucket], len(sample))
                    size += np.bincount(owner, minlength=len(sample))
                begins, heads = _passages(words.first)
                length = np.diff(np.append(begins, len(words.hashes)))
                passage = np.add.reduceat((total / size)[number], begins) / length
                full = np.flatnonzero(words.counts() > 0)
                logit[full] = np.maximum.reduceat(passage, heads[full]) + bias
            found = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                names=[*batch.schema.names, *names],
            )

    schema = docs.limit(0).select("*", F.lit(0.0).alias(names[0]), F.lit(0).alias(names[1])).schema
    return map_rows(docs, run, schema)


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those predicted toxic; null and empty texts stay."""
    scored = score(docs, learn(docs, labels), ("__score", "__predicted"))
    return scored.where("__predicted = 0").select(*docs.columns)
