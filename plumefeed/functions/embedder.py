"""Text to unit vectors in Arrow batches.

An embedder is any picklable object with ``dim`` and ``load()``; ``load`` runs once per
Python worker and returns a function from a list of texts to a float32 matrix.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

BATCH_SIZE = 32


class Embedder(Protocol):
    dim: int

    def load(self) -> Callable[[list[str]], np.ndarray]: ...


class HashingEmbedder:
    """Signed bag of words: each word adds +1 or -1 to one component.

    Takes more texts at a time than a neural model would.

    Needs no model file. Component and sign come from the MD5 digest of the word.
    """

    batch_size = 1024

    def __init__(self, dim: int = 384):
        self.dim = dim

    def load(self) -> Callable[[list[str]], np.ndarray]:
        dim, slots = self.dim, {}

        def slot(word: str) -> tuple[int, int]:
            if word not in slots:
                if len(slots) > 200_000:
                    slots.clear()
                digest = hashlib.md5(word.encode("utf-8")).hexdigest()
                sign = 1 if int(digest[8], 16) < 8 else -1
                slots[word] = (int(digest[:8], 16) % dim, sign)
            return slots[word]

        def embed(texts: list[str]) -> np.ndarray:
            # ASCII white space separates words; each distinct word is hashed once.
            words = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
            row = pc.list_parent_indices(words).to_numpy(zero_copy_only=False)
            codes = pc.list_flatten(words).dictionary_encode()
            slots_ = np.array([slot(w) if w else (0, 0) for w in codes.dictionary.to_pylist()])
            where, sign = slots_.reshape(-1, 2)[codes.indices.to_numpy(zero_copy_only=False)].T
            flat = np.bincount(row * dim + where, weights=sign, minlength=len(texts) * dim)
            return unit_rows(flat.reshape(len(texts), dim)).astype(np.float32)

        return embed


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zero rows stay zero."""
    length = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return np.divide(matrix, length, out=np.zeros_like(matrix, dtype=float), where=length > 0)


def _run(
    model: Callable[[list[str]], np.ndarray], texts: list[str], dim: int, size: int
) -> np.ndarray:
    parts = [model(texts[i : i + size]) for i in range(0, len(texts), size)]
    out = np.concatenate(parts) if parts else np.zeros((0, dim), dtype=np.float32)
    if out.shape != (len(texts), dim):
        raise ValueError(f"the model returned {out.shape}, expected {(len(texts), dim)}")
    return out.astype(np.float32, copy=False)


def to_list_array(matrix: np.ndarray, valid: np.ndarray | None = None) -> pa.ListArray:
    """A matrix as Arrow lists of floats; rows where ``valid`` is false become NULL."""
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    values = pa.array(matrix.astype(np.float32, copy=False).ravel())
    mask = None if valid is None else pa.array(~valid)
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=mask)


def to_matrix(vectors: pa.Array, dim: int | None = None) -> np.ndarray:
    """Arrow lists of equal length as a float64 matrix."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = pc.list_flatten(vectors).to_numpy(zero_copy_only=False).astype(np.float64)
    width = dim or (len(flat) // len(vectors) if len(vectors) else 0)
    return flat.reshape(len(vectors), width)


def embed(text: Column, embedder: Embedder) -> Column:
    """Vector of a text column; NULL stays NULL."""

    size = getattr(embedder, "batch_size", BATCH_SIZE)

    @F.arrow_udf("array<float>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = embedder.load()
        for texts in batches:
            values = [t or "" for t in texts.to_pylist()]
            valid = texts.is_valid().to_numpy(zero_copy_only=False)
            yield to_list_array(_run(model, values, embedder.dim, size), valid)

    return run.asNondeterministic()(text)


def embed_mean(texts: Column, embedder: Embedder) -> Column:
    """Mean vector of an array of texts, as doubles and not yet normalised.

    The array is one row, so nothing is shuffled. NULL or empty gives NULL.
    """

    size = getattr(embedder, "batch_size", BATCH_SIZE)

    @F.arrow_udf("array<double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = embedder.load()
        for lists in batches:
            flat = pc.list_flatten(lists).to_pylist()
            row = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
            vectors = _run(model, flat, embedder.dim, size).astype(np.float64)
            total = np.zeros((len(lists), embedder.dim))
            np.add.at(total, row, vectors)
            n = np.bincount(row, minlength=len(lists))
            mean = total / np.maximum(n, 1)[:, None]
            offsets = np.arange(len(lists) + 1, dtype=np.int32) * embedder.dim
            yield pa.ListArray.from_arrays(
                pa.array(offsets), pa.array(mean.ravel()), mask=pa.array(n == 0)
            )

    return run.asNondeterministic()(texts)
