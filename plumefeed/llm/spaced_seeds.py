"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over consecutive words; only the words at its marked positions are
hashed, so a substituted word at an ignored position does not hide a match. Hashes of
benchmark and documents are joined, and on the diagonal of every hit all stretches are
looked at, tolerating substitutions.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import materialize
from .textops import ascii_words, constants, list_array, map_rows, mix, signed, slices, words_of

# 1: the word counts, 0: it may be anything.
MASKS = ("111111", "11011011", "1101100111", "10110100101")
# Words between hits that make one region; an item's length is kept on either side of it.
CONTEXT = 48
# Bits of the filter with the benchmark's hashes: 4 MB on every executor, whatever its size.
FILTER_BITS = 1 << 25


def _seeds(codes: np.ndarray, first: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Positions and hashes of each mask, inside the rows that ``first`` bounds."""
    ends = np.repeat(first[1:], np.diff(first))
    out = []
    for number, mask in enumerate(MASKS):
        n = len(codes) - len(mask) + 1
        if n <= 0:
            out.append((np.empty(0, np.int64), np.empty(0, np.uint64)))
            continue
        total = np.full(n, number + 1, np.uint64)
        for j, factor in enumerate(constants(41, len(mask))):
            if mask[j] == "1":
                total += codes[j : j + n] * factor
        fits = np.flatnonzero(np.arange(n) + len(mask) <= ends[:n])
        out.append((fits, mix(total[fits])))
    return out


def benchmark_words(items: DataFrame) -> DataFrame:
    """``item_id``, word codes, and all seeds with their positions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, text in slices(batches):
            words = words_of(text, ascii_words())
            seeds = _seeds(words.hashes, words.first)
            at = np.concatenate([s[0] for s in seeds])
            found = np.concatenate([s[1] for s in seeds])
            row = np.searchsorted(words.first, at, "right") - 1
            parts = [np.flatnonzero(row == i) for i in range(len(text))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item_id").cast(pa.int64()),
                    list_array([signed(p) for p in np.split(words.hashes, words.first[1:-1])], pa.int64()),
                    list_array([signed(found[p]) for p in parts], pa.int64()),
                    list_array([at[p] - words.first[i] for i, p in enumerate(parts)], pa.int64()),
                ],
                names=["item_id", "item_words", "seeds", "places"],
            )

    schema = "item_id long, item_words array<long>, seeds array<long>, places array<long>"
    items = items.where("item_id is not null").select("item_id", "text")
    return map_rows(items, run, schema)


def _filter_pages(seeds: DataFrame) -> np.ndarray:
    """A bit set with two bits of every seed; its size does not depend on the benchmark."""
    half = FILTER_BITS // 2
    spots = seeds.select(
        F.explode(
            F.array(
                F.pmod("seed", F.lit(half)), F.pmod(F.shiftright("seed", 32), F.lit(half)) + half
            )
        ).alias("spot")
    ).where("spot is not null")
    page = F.shiftright("spot", 15).alias("page")
    bit = F.bitmap_bit_position(F.col("spot") + 1)
    # A page has 4 KB, so at most FILTER_BITS / 8 bytes come here.
    pages = spots.withColumn("bit", bit).groupBy(page).agg(F.bitmap_construct_agg("bit").alias("bits"))
    out = np.zeros((FILTER_BITS >> 15, 4096), np.uint8)
    for row in pages.collect():
        out[row.page] = np.frombuffer(row.bits, np.uint8)
    return out.ravel()


def _regions(docs: DataFrame, bits: bytes, longest: int) -> DataFrame:
    """Stretches of documents around words whose seeds pass the filter.

    ``longest`` words on either side hold all of an item that lies over a hit.
    """
    half = FILTER_BITS // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(bits, np.uint8)

        def passes(seed: np.ndarray) -> np.ndarray:
            low = (signed(seed) % half).astype(np.int64)
            hit = (table[low >> 3] >> (low & 7).astype(np.uint8)) & 1
            some = np.flatnonzero(hit)
            high = (signed(seed[some]) >> 32) % half + half
            return some[((table[high >> 3] >> (high & 7).astype(np.uint8)) & 1) == 1]

        for batch, text in slices(batches):
            words = words_of(text, ascii_words())
            where, what = [], []
            for at, seed in _seeds(words.hashes, words.first):
                good = passes(seed)
                where.append(at[good])
                what.append(seed[good])
            where, what = np.concatenate(where), np.concatenate(what)
            order = np.argsort(where, kind="stable")
            where, what = where[order], what[order]
            row = np.searchsorted(words.first, where, "right") - 1
            new = np.ones(len(where), bool)
            new[1:] = (row[1:] != row[:-1]) | (np.diff(where) > 2 * CONTEXT)
            begin = np.flatnonzero(new)
            stop = np.append(begin[1:], len(where))[: len(begin)]
            low = np.maximum(where[begin] - longest, words.first[row[begin]])
            high = np.minimum(where[stop - 1] + longest, words.first[row[begin] + 1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row[begin])).cast(pa.int64()),
                    pa.array(low - words.first[row[begin]]),
                    list_array([signed(words.hashes[x:y]) for x, y in zip(low, high)], pa.int64()),
                    list_array([signed(what[x:y]) for x, y in zip(begin, stop)], pa.int64()),
                    list_array([where[x:y] - b for x, y, b in zip(begin, stop, low)], pa.int64()),
                ],
                names=["doc_id", "base", "doc_words", "seeds", "places"],
            )

    schema = (
        "doc_id long, base long, doc_words array<long>, seeds array<long>, places array<long>"
    )
    found = map_rows(docs.where("doc_id is not null").select("doc_id", "text"), run, schema)
    return found.withColumn("region", F.xxhash64("doc_id", "base", "doc_words"))


def _extent(same: np.ndarray, identity: float) -> tuple[int, int]:
    """The stretch of one diagonal with most equal words among all with a share of ``identity``.

    ``same`` marks equal words. Of stretches with as many equal words the shortest counts, then
    the first. Sums over words never fall below zero in a stretch that has the share, so the
    last end that fits a begin is found in the maxima of the sums that follow. Whole numbers
    keep a share of exactly ``identity``.
    """
    share = Fraction(str(identity))
    begins = np.flatnonzero(same)
    if not len(begins):
        return 0, 0
    total = np.zeros(len(same) + 1, np.int64)
    np.cumsum(np.where(same, share.denominator - share.numerator, -share.numerator), out=total[1:])
    # Sums after each equal word, as no best stretch ends elsewhere; falling from the left.
    after = np.maximum.accumulate(total[begins + 1][::-1])[::-1]
    last = np.searchsorted(-after, -total[begins], "right") - 1
    equal = last - np.arange(len(begins)) + 1
    size = begins[last] - begins + 1
    best = np.lexsort((begins, size, -equal))[0]
    return int(begins[best]), int(begins[last[best]]) + 1


def overlaps(
    docs: DataFrame, items: DataFrame, min_words: int = 10, identity: float = 0.8
) -> DataFrame:
    """Benchmark passages in documents: one row per document and item, with the best overlap.

    Returns ``doc_id, item_id, doc_start, item_start, n_words, n_same``: where the overlap
    begins (words from 0), its length and its equal words. An overlap counts with
    ``min_words`` equal words, or all words of a shorter item, at a share of ``identity``.
    Items with fewer words than the shortest mask have no seeds and match nothing.

    Words are runs of letters and digits in lower case. Null and empty texts match nothing,
    rows with a null id are left out, rows that repeat an id are looked at one by one and the
    best overlap counts. Other columns are ignored. Empty tables give an empty result.
    """
    bench = materialize(benchmark_words(items), "benchmark")
    seeds = bench.select("item_id", F.explode(F.arrays_zip("seeds", "places")).alias("s"))
    seeds = seeds.select("item_id", F.col("s.seeds").alias("seed"), F.col("s.places").alias("item_at"))
    bits = _filter_pages(seeds).tobytes()
    longest = bench.agg(F.max(F.size("item_words"))).first()[0] or 0
    regions = materialize(_regions(docs, bits, longest), "regions")
    hits = regions.select(
        "doc_id", "region", F.explode(F.arrays_zip("seeds", "places")).alias("s")
    ).select("doc_id", "region", F.col("s.seeds").alias("seed"), F.col("s.places").alias("doc_at"))
    found = hits.join(seeds, "seed").select(
        "doc_id", "region", "item_id", (F.col("doc_at") - F.col("item_at")).alias("shift")
    )
    lines = found.distinct()
    with_doc = lines.join(regions.select("doc_id", "region", "base", "doc_words"), ["doc_id", "region"])
    full = with_doc.join(bench.select("item_id", "item_words"), "item_id")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = [batch.column(c) for c in ("doc_id", "item_id", "base", "shift")]
            for i, (doc, item, base, shift) in enumerate(zip(*(c.to_pylist() for c in columns))):
                text, ref = (batch.column(c)[i].values.to_numpy() for c in ("doc_words", "item_words"))
                low, high = max(0, -shift), min(len(ref), len(text) - shift)
                same = ref[low:high] == text[low + shift : high + shift]
                start, end = _extent(same, identity)
                equal = int(same[start:end].sum())
                if end > start and equal >= min(min_words, len(ref)):
                    out.append((doc, item, base + shift + low + start, low + start, end - start, equal))
            columns = list(zip(*out)) if out else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    names = ["doc_id", "item_id", "doc_start", "item_start", "n_words", "n_same"]
    columns = ["doc_id", "item_id", "base", "shift", "doc_words", "item_words"]
    checked = map_rows(full.select(*columns), verify, ", ".join(f"{c} long" for c in names))
    order = F.struct(
        F.col("n_same").alias("same"),
        (-F.col("n_words")).alias("short"),
        (-F.col("doc_start")).alias("early"),
        (-F.col("item_start")).alias("first"),
    )
    best = checked.groupBy("doc_id", "item_id").agg(F.max(order).alias("top"))
    return best.select(
        "doc_id",
        "item_id",
        (-F.col("top.early")).alias("doc_start"),
        (-F.col("top.first")).alias("item_start"),
        (-F.col("top.short")).alias("n_words"),
        F.col("top.same").alias("n_same"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without those that hold a benchmark passage; rows with a null id stay."""
    leaked = overlaps(docs, items).select("doc_id").distinct()
    return docs.join(leaked, "doc_id", "left_anti").select(*docs.columns)
