"""Token counts of byte-pair vocabularies by heap and linked list, without any ids.

The adjacent pair of the best rank is popped again and again from a heap over a linked list
of symbols; the count is the number of symbols at the start less the number of merges.

Two neighbouring characters that no piece of the vocabulary contains side by side can never
be merged across, so texts fall into independent segments, and each distinct segment is
merged once per task.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import _powers, as_text, constants, kept, map_rows, mix, slices, text_buffers

BLANK = "▁"
# Segment counts a Python worker remembers.
CACHE_SIZE = 600_000


@dataclass(frozen=True)
class Vocabulary:
    """Ranks of the mergeable pieces (smaller goes first) and which pairs occur in them."""

    ranks: dict[str, float]
    letter: np.ndarray  # code point -> number of the character, 0 for all others
    pair: np.ndarray  # whether two numbered characters stand side by side in a piece


def read_vocabulary(model_file: str) -> Vocabulary:
    """The pieces of a byte-fallback pair model without text normalisation.

    Other kinds of models raise ValueError: their counts would differ.
    """
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(model_file, "rb") as f:
        model.ParseFromString(f.read())
    rules, kinds = model.normalizer_spec, model.SentencePiece
    plain = (
        model.trainer_spec.model_type == 2
        and model.trainer_spec.byte_fallback
        and not rules.precompiled_charsmap
        and rules.add_dummy_prefix
        and rules.escape_whitespaces
        and not rules.remove_extra_whitespaces
        and not model.trainer_spec.treat_whitespace_as_suffix
    )
    if not plain or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
        raise ValueError(f"{model_file}: not a plain byte-fallback pair model")
    ranks = {p.piece: -p.score for p in model.pieces if p.type == kinds.NORMAL}
    letters = sorted({c for p in ranks if len(p) > 1 for c in p})
    number = {c: i + 1 for i, c in enumerate(letters)}
    letter = np.zeros(0x110000, np.uint16)
    letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
    letter[0x20] = letter[ord(BLANK)]
    pair = np.zeros((len(letters) + 1,) * 2, bool)
    for p in ranks:
        for a, b in zip(p, p[1:]):
            pair[number[a], number[b]] = True
    return Vocabulary(ranks, letter, pair)


def count_segment(text: str, ranks: dict[str, float]) -> int:
    """Tokens of one segment, in which blanks are already ``BLANK``."""
    n = len(text)
    if n == 1:
        return 1 if text in ranks else len(text.encode("utf-8"))
    # Symbol i covers text[i:end[i]]; before[j] is where the symbol that ends at j begins.
    end = list(range(1, n + 1))
    before = list(range(-1, n))
    heap = []
    for i in range(n - 1):
        rank = ranks.get(text[i : i + 2])
        if rank is not None:
            heap.append((rank, i, i + 2))
    heapq.heapify(heap)
    pop, push, find = heapq.heappop, heapq.heappush, ranks.get
    left = n
    while heap:
        _, i, stop = pop(heap)
        middle = end[i]
        # Stale: a symbol of the pair has been merged with another one.
        if middle == 0 or middle >= stop or end[middle] != stop:
            continue
        end[i], end[middle] = stop, 0
        before[stop] = i
        left -= 1
        if i:
            first = before[i]
            rank = find(text[first:stop])
            if rank is not None:
                push(heap, (rank, first, stop))
        if stop < n:
            rank = find(text[i : end[stop]])
            if rank is not None:
                push(heap, (rank, i, end[stop]))
    at = 0
    while at < n:
        # A symbol left alone and unknown is spelled in bytes.
        if end[at] == at + 1 and text[at] not in ranks:
            left += len(text[at].encode("utf-8")) - 1
        at = end[at]
    return left


def _count(text: pa.Array, vocabulary: Vocabulary, known: dict[int, int]) -> np.ndarray:
    """Tokens of every text of a piece of a batch."""
    blank, nothing = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
    lead = pc.if_else(pc.greater(pc.binary_length(text), 0), blank, nothing)
    raw, at = text_buffers(as_text(pc.binary_join_element_wise(lead, text, nothing)))
    whole = raw.tobytes().decode("utf-8")
    points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    if not len(points):
        return np.zeros(len(text), np.int64)
    begins = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=begins[1:])
    rows = begins[at]

    letters = vocabulary.letter[points]
    cut = np.ones(len(points), bool)
    cut[1:] = ~vocabulary.pair[letters[:-1], letters[1:]]
    cut[rows[:-1][rows[:-1] < len(points)]] = True
    start = np.flatnonzero(cut)
    stop = np.append(start[1:], len(points))

    up, down = _powers(len(points) + 1)
    total = np.zeros(len(points) + 1, np.uint64)
    points = np.where(points == 0x20, np.uint32(ord(BLANK)), points)
    spread = mix(points.astype(np.uint64) + constants(51, 1)[0])
    np.cumsum(spread * up[: len(points)], out=total[1:])
    codes = mix((total[stop] - total[start]) * down[start] + (stop - start).astype(np.uint64))
    distinct, sample, inverse = np.unique(codes, return_index=True, return_inverse=True)
    if len(known) + len(distinct) > CACHE_SIZE:
        known.clear()
    counts = np.empty(len(distinct), np.int64)
    ranks = vocabulary.ranks
    for k, (code, a, b) in enumerate(
        zip(distinct.tolist(), start[sample].tolist(), stop[sample].tolist())
    ):
        n = known.get(code)
        if n is None:
            n = known[code] = count_segment(whole[a:b].replace(" ", BLANK), ranks)
        counts[k] = n
    sums = np.zeros(len(start) + 1, np.int64)
    np.cumsum(counts[inverse], out=sums[1:])
    first = np.searchsorted(start, rows)
    return sums[first[1:]] - sums[first[:-1]]


def count_tokens(docs: DataFrame, model: str = "piece_bpe_32k.model", limit: int = 4096) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every text, as the library counts them.

    ``model`` is a name in the folder of public tokenizers or a path; it is read by the
    tasks, so executors need the file too. No marks for beginning or end are added, and the
    strings of special tokens inside texts are ordinary text.

    Null and empty texts have no bytes and no tokens. Every row gives a row, also with a null
    or repeated id. Other columns are ignored; an empty table gives an empty result.
    """

    def load() -> Vocabulary:
        import public_tokenizers

        return read_vocabulary(model if "/" in model else public_tokenizers.path(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = kept(f"vocabulary {model}", load)
        known = kept(f"segments {model}", dict)
        for batch, text in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pc.binary_length(text).cast(pa.int64()),
                    pa.array(_count(text, vocabulary, known)),
                ],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    counted = map_rows(docs.select("doc_id", "text"), run, "doc_id long, n_bytes long, n_tokens long"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
