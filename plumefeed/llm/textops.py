"""Shared helpers: words of Arrow text batches as arrays, joins by id, bounded filters.

Words are kept as 64-bit hashes in flat numpy arrays, so the work per word stays out of
Python. Null texts are empty texts everywhere.
"""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text handled at a time inside a task; one longer text is handled alone.
SLICE_BYTES = 1 << 20
# Rows that travel to Python together.
BATCH_BYTES = 8 << 20
# Slots of the filter in front of a join by id; it bounds what is broadcast.
SLOTS = 1 << 18


def kept(name: str, make: Callable[[], object]) -> object:
    """What a Python worker keeps between its tasks; ``make`` runs at the first use."""
    store = sys.modules.setdefault("_plumefeed_kept", types.ModuleType("_plumefeed_kept"))
    if not hasattr(store, name):
        setattr(store, name, make())
    return getattr(store, name)


def give_back() -> None:
    """Return memory that the allocators of this worker keep, but nothing uses."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _giving_back(run: Callable) -> Callable:
    """``run``, and :func:`give_back` at the end: workers outlive their tasks and stages."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def map_rows(table: DataFrame, run: Callable, schema: object) -> DataFrame:
    """``mapInArrow`` in batches of at most ``BATCH_BYTES``, one row at least.

    Executors hold a batch several times, on both sides. The session's own setting is
    lowered to this if it is higher. A worker gives its memory back after each task.
    """
    conf, name = table.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(conf.get(name).removesuffix("b")) > BATCH_BYTES:
        conf.set(name, BATCH_BYTES)
    return table.mapInArrow(_giving_back(run), schema)


def as_text(column: pa.Array) -> pa.Array:
    """Strings with 64-bit offsets, nulls as empty strings."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def text_buffers(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins (one more entry than texts)."""
    if not len(text):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    buffer = text.buffers()[2]
    raw = np.empty(0, np.uint8) if buffer is None else np.frombuffer(buffer, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Pieces of the batches with at most ``size`` bytes of text, but one row at least."""
    for batch in batches:
        text = as_text(batch.column(column))
        _, at = text_buffers(text)
        row = 0
        while row < len(text):
            last = max(row + 1, int(np.searchsorted(at, at[row] + size, "right")) - 1)
            yield batch.slice(row, last - row), text.slice(row, last - row)
            row = last


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(seed: int, n: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Table of 256 flags, true inside the inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


def ascii_words() -> np.ndarray:
    """Letters and digits of ASCII, and every byte of other characters."""
    return byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def non_space() -> np.ndarray:
    """All bytes but blank, tab, line feed, vertical tab, form feed, carriage return."""
    return ~byte_class((0x20, 0x20), (0x09, 0x0D))


@dataclass
class Words:
    """Words of several texts: byte range and hash of each; row i has words first[i]:first[i+1]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    base = 0x9E3779B97F4A7C15
    have = kept("powers", dict)
    if len(have.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, value in (("up", base), ("down", pow(base, -1, 1 << 64))):
            steps = np.full(size, value, np.uint64)
            steps[0] = 1
            have[name] = np.cumprod(steps)
    return have["up"], have["down"]


def words_of(text: pa.Array, word_bytes: np.ndarray, fold: bool = True) -> Words:
    """Maximal runs of ``word_bytes`` in each text, hashed, with A-Z as a-z if ``fold``."""
    data, at = text_buffers(text)
    inside = word_bytes[data]
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    if len(data):
        before[0], after[-1] = False, False
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = at[1:-1]
        before[edges[edges < len(data)]] = False
        after[edges[edges > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(start, at)
    return Words(data, start, end, first, run_hashes(data, start, end, fold))


def run_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool = False) -> np.ndarray:
    """Hash of the bytes from each ``start`` to its ``end``, with A-Z as a-z if ``fold``."""
    codes = constants(7, 256)
    if fold:
        codes[0x41:0x5B] = codes[0x61:0x7B]
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(codes[data] * up[: len(data)], out=total[1:])
    return mix((total[end] - total[start]) * down[start])


def shingle_sets(words: Words, width: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each row's ``width`` words in a row.

    A row with fewer words has one shingle of all of them, a row without words none.
    """
    n = len(words.hashes)
    code, factors = words.hashes, constants(11, width)
    runs = np.zeros(max(0, n - width + 1), np.uint64)
    for j in range(width):
        runs += code[j : j + len(runs)] * factors[j]
    runs = mix(runs)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(runs[a : b - width + 1]))
        elif b > a:
            short = (code[a:b] * factors[: b - a]).sum(dtype=np.uint64, keepdims=True)
            out.append(mix(short + np.uint64(b - a)))
        else:
            out.append(code[:0])
    return out


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as Spark's bigint."""
    return x.view(np.int64)


def list_array(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    at = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=at[1:])
    flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat, kind))


def fetch(table: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``table`` joined with the distinct ``ids`` by ``key``.

    Only rows whose hashed slot is wanted are shuffled. The slots are bounded by ``SLOTS``,
    so they are broadcast whatever the number of ids. The ids themselves may be many and are
    never broadcast. ``ids`` should be a written table, as it is read twice.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(SLOTS))
    slots = ids.select(slot.alias("__slot")).distinct()
    near = table.withColumn("__slot", slot).join(F.broadcast(slots), "__slot", "left_semi")
    return near.drop("__slot").join(ids.hint("merge"), key)


def held_out(key: str = "doc_id") -> Column:
    """Every fifth document by the checksum of its id; false where the id is null."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def bounded_sample(rows: DataFrame, group: str, key: str, bound: int) -> DataFrame:
    """About ``bound`` rows of each value of ``group``, all of them if there are fewer.

    Chosen by a hash of ``key`` against the group's count, so nothing is sorted or gathered.
    """
    counts = rows.groupBy(group).agg(F.count("*").alias("__n"))
    share = F.lit(float(bound)) / F.col("__n")
    spot = F.pmod(F.xxhash64(F.col(key), F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    return rows.join(counts, group).where(spot < share).drop("__n")


@dataclass
class Marked:
    """Some words of a batch with ``<`` and ``>`` around, in lower case, back to back."""

    data: np.ndarray
    first: np.ndarray  # where each word begins, one more entry than words

    def grams(self, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashed bucket and word of every run of ``n`` bytes; 0 stands for whole words."""
        codes = constants(61, 256)
        if n == 0:
            up, down = _powers(len(self.data) + 1)
            total = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(codes[self.data] * up[: len(self.data)], out=total[1:])
            whole = (total[self.first[1:]] - total[self.first[:-1]]) * down[self.first[:-1]]
            return (mix(whole) >> np.uint64(64 - bits)).astype(np.int64), np.arange(len(whole))
        size = max(0, len(self.data) - n + 1)
        runs = np.full(size, n, np.uint64)
        for j, factor in enumerate(constants(62, n)):
            runs += codes[self.data[j : j + size]] * factor
        owner = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))[:size]
        inside = np.arange(size) + n <= self.first[owner + 1]
        return (mix(runs[inside]) >> np.uint64(64 - bits)).astype(np.int64), owner[inside]


def marked(words: Words, pick: np.ndarray) -> Marked:
    size = words.end[pick] - words.start[pick]
    first = np.zeros(len(pick) + 1, np.int64)
    np.cumsum(size + 2, out=first[1:])
    out = np.full(first[-1], ord("<"), np.uint8)
    out[first[1:] - 1] = ord(">")
    target = np.repeat(first[:-1] + 1, size) + _steps(size)
    raw = words.data[np.repeat(words.start[pick], size) + _steps(size)]
    out[target] = raw + ((raw >= 0x41) & (raw <= 0x5A)).astype(np.uint8) * 32
    return Marked(out, first)


def _steps(size: np.ndarray) -> np.ndarray:
    """0, 1, ... for each size, one after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size)
