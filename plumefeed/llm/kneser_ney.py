"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is over characters. Counts of all orders are sharded tables; joins of contexts
and shorter grams give a probability for every gram that any text asks for. Documents are
scored in blocks: a block asks once for each of its distinct grams, so common grams do not
cross the cluster once per document. Texts move once, compressed, to meet the answers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import materialize
from .textops import fetch, held_out, map_rows, mix, non_space, signed, slices, text_buffers, words_of

# Characters of a gram, and bits of a character in its packed form: all of Unicode. The last
# three characters are one integer, ``gram``; the one before them is ``far``, 0 in shorter grams.
ORDER, CHAR_BITS = 4, 21
# Text of one block, and distinct grams a task adds up before it passes them on.
BLOCK_BYTES, HELD_GRAMS = 8 << 20, 2_000_000


def _grams(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``far`` and ``gram`` that end at each character, and where each text begins.

    Places before the first character of a text are filled with 0, which no character is.
    """
    raw, at = text_buffers(text)
    points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    begins = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=begins[1:])
    rows = begins[at]
    chars = points.astype(np.int64) + 1
    into = np.arange(len(chars)) - np.repeat(rows[:-1], np.diff(rows))
    far, gram = np.zeros_like(chars), chars.copy()
    for back in range(1, ORDER):
        before = np.zeros_like(chars)
        before[back:] = chars[:-back] if len(chars) > back else before[back:]
        before[into < back] = 0
        if back == ORDER - 1:
            far = before
        else:
            gram |= before << (CHAR_BITS * back)
    return far, gram, rows


def _code(far: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """64 bits that tell grams apart inside a task."""
    return gram ^ signed(mix(far.astype(np.uint64)))


def _added(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct grams in order, as ``far`` and ``gram``, and the sums of their counts."""
    far, gram, n = (np.concatenate(c) for c in zip(*parts))
    _, first, place = np.unique(_code(far, gram), return_index=True, return_inverse=True)
    # Counts are far below 2**53, where doubles are exact.
    n = np.bincount(place, n, len(first)).astype(np.int64)
    far, gram = far[first], gram[first]
    order = np.lexsort((gram, far))
    return far[order], gram[order], n[order]


def _distinct(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    far, gram, _ = _grams(text)
    _, first, n = np.unique(_code(far, gram), return_index=True, return_counts=True)
    return far[first], gram[first], n


def _count_grams(texts: DataFrame) -> DataFrame:
    """``far, gram, n`` over all texts, added up in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = held = (np.empty(0, np.int64),) * 3
        pack = lambda c: pa.RecordBatch.from_arrays(
            [pa.array(c[0], pa.int32()), pa.array(c[1]), pa.array(c[2])], names=["far", "gram", "n"]
        )
        for _, text in slices(batches):
            held = _added([held, _distinct(text)])
            if len(held[0]) > HELD_GRAMS:
                yield pack(held)
                held = none
        yield pack(held)

    found = map_rows(texts.select("text"), run, "far int, gram long, n long")
    return found.groupBy("far", "gram").agg(F.sum("n").alias("n"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, pa.Array]]:
    """Pieces of the batches, with a number that depends on their ids and words only."""
    for batch, text in slices(batches, size=BLOCK_BYTES):
        ids = batch.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        first = words_of(text.slice(0, 1), non_space()).hashes.sum(dtype=np.uint64)
        seed = np.array([first + np.uint64(len(text_buffers(text)[0]))], np.uint64)
        spread = mix(ids.view(np.uint64) + np.arange(len(ids), dtype=np.uint64) * np.uint64(2654435761))
        yield int(signed(mix(seed + spread.sum(dtype=np.uint64)))[0]), batch, text


def _probabilities(counts: DataFrame, asked: DataFrame) -> DataFrame:
    """``far, gram, logp`` for the distinct grams of ``asked`` (columns ``far, gram``).

    Orders below the highest count distinct left neighbours instead of occurrences. Each
    order has three discounts from its own counts of counts.
    """
    levels, wanted = {ORDER: counts}, {ORDER: asked}
    none = F.lit(0).alias("far")
    for k in range(ORDER - 1, 0, -1):
        tail = F.col("gram").bitwiseAND(F.lit((1 << CHAR_BITS * k) - 1)).alias("gram")
        levels[k] = levels[k + 1].select(tail).groupBy("gram").agg(F.count("*").alias("n"))
        levels[k] = materialize(levels[k].select(none, "gram", "n"), f"grams-{k}")
        wanted[k] = wanted[k + 1].select(tail).distinct().select(none, "gram")
        wanted[k] = materialize(wanted[k], f"asked-{k}")
    # One more character than seen stands for all others.
    seen = levels[1].count()
    lower = wanted[1].select(F.lit(0).cast("long").alias("tail"), F.lit(1.0 / (seen + 1)).alias("low"))
    lower = lower.distinct()
    for k in range(1, ORDER + 1):
        table = levels[k]
        few = {r.n: r.times for r in table.where("n <= 4").groupBy("n").agg(F.count("*").alias("times")).collect()}
        t1, t2, t3, t4 = (few.get(i, 0) for i in (1, 2, 3, 4))
        share = t1 / (t1 + 2 * t2) if t1 and t2 else 0.5
        pull = [
            min(max(i - (i + 1) * share * b / a, 0.1), i) if a and b else 0.5 * i
            for i, a, b in ((1, t1, t2), (2, t2, t3), (3, t3, t4))
        ]
        before = F.shiftleft(F.col("far").cast("long"), CHAR_BITS * (ORDER - 2))
        head = F.shiftright("gram", CHAR_BITS).bitwiseOR(before).alias("head")
        has = lambda i: F.sum((F.col("n") == i).cast("long"))
        contexts = table.groupBy(head).agg(
            F.sum("n").alias("total"),
            (
                has(1) * pull[0] + has(2) * pull[1] + F.sum((F.col("n") >= 3).cast("long")) * pull[2]
            ).alias("spare"),
        )
        off = F.when(F.col("n") == 1, pull[0]).when(F.col("n") == 2, pull[1]).otherwise(pull[2])
        tail = F.col("gram").bitwiseAND(F.lit((1 << CHAR_BITS * (k - 1)) - 1)).alias("tail")
        rows = wanted[k].select("far", "gram", head, tail)
        both = ["far", "gram"] if k == ORDER else ["gram"]
        rows = rows.join(table.select(*both, "n"), both, "left").join(contexts, "head", "left").join(lower, "tail")
        own = F.coalesce((F.col("n") - off) / F.col("total"), F.lit(0.0))
        rest = F.coalesce(F.col("spare") / F.col("total"), F.lit(1.0))
        p = (own + rest * F.col("low")).alias("low")
        top = ["far"] if k == ORDER else []
        lower = materialize(rows.select(*top, F.col("gram").alias("tail"), p), f"order-{k}")
    return lower.select("far", F.col("tail").alias("gram"), F.log("low").alias("logp"))


def perplexities(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """``doc_id, lang, n_chars, perplexity`` of every text under a model of trusted texts.

    ``trusted`` names documents by ``doc_id``. Null and empty texts have no perplexity.
    ``docs`` is read twice and must give the same rows both times.
    """
    ids = trusted.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"))
    ids = materialize(ids.distinct(), "trusted")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string"))
    counts = materialize(_count_grams(fetch(source.select("doc_id", "text"), ids)), "counts")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, text in _blocks(batches):
            far, gram, _ = _added([_distinct(t) for _, t in slices(iter([_one(text)]))])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(gram), block)), pa.array(far, pa.int32()), pa.array(gram)],
                names=["block", "far", "gram"],
            )

    asked = materialize(map_rows(source, ask, "block long, far int, gram long"), "asked")
    known = _probabilities(counts, asked.select("far", "gram").distinct())
    answers = asked.join(known, ["far", "gram"]).select("block", "far", "gram", "logp")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))
        for block, batch, _ in _blocks(batches):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
                out.write_batch(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                names=["block", "rows"],
            )

    def measure(left: pa.Table, right: pa.Table) -> pa.Table:
        codes = _code(right.column("far").to_numpy(), right.column("gram").to_numpy())
        order = np.argsort(codes)
        codes, logs = codes[order], right.column("logp").to_numpy()[order]
        out = []
        for rows in left.column("rows").to_pylist():
            for batch in pa.ipc.open_stream(rows):
                for piece, text in slices(iter([batch])):
                    far, gram, begins = _grams(text)
                    own = _code(far, gram)
                    at = np.searchsorted(codes, own)
                    if len(own) and (at.max() >= len(codes) or (codes[at] != own).any()):
                        raise ValueError("the documents changed between two reads")
                    total = np.zeros(len(own) + 1)
                    np.cumsum(logs[at], out=total[1:])
                    size = np.diff(begins)
                    mean = (total[begins[1:]] - total[begins[:-1]]) / np.maximum(size, 1)
                    value = pa.array(np.exp(-mean), mask=size == 0)
                    out.append(
                        pa.table(
                            [piece.column("doc_id"), piece.column("lang"), pa.array(size), value],
                            names=["doc_id", "lang", "n_chars", "perplexity"],
                        )
                    )
        return pa.concat_tables(out) if out else empty()

    schema = "doc_id long, lang string, n_chars long, perplexity double"
    empty = pa.schema(
        [("doc_id", pa.int64()), ("lang", pa.string()), ("n_chars", pa.int64()), ("perplexity", pa.float64())]
    ).empty_table
    texts = map_rows(source, packed, "block long, rows binary")
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(measure, schema)


def _one(text: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([text], names=["text"])


def judge_quality(
    docs: DataFrame, trusted: DataFrame, quantile: float = 0.99, least: int = 20
) -> DataFrame:
    """``doc_id, lang, n_chars, perplexity, threshold, kept`` of every document.

    The model learns from four fifths of the trusted texts; the others, by the checksum of
    their ids, say what a new trusted text looks like. A text is kept while its perplexity is
    at most the ``quantile`` of those of its language; a language with fewer than ``least`` of
    them takes the quantile of all. Null and empty texts have no perplexity and are not kept.
    Where no trusted text was left out there is no threshold, and every text with a character
    is kept. A null language is one of its own. Every row gives a row, also with a null or
    repeated id; other columns are ignored.
    """
    measured = materialize(perplexities(docs, trusted.where(~held_out())), "perplexities")
    ids = trusted.where(F.col("doc_id").isNotNull() & held_out())
    ids = ids.select(F.col("doc_id").cast("long").alias("doc_id"))
    good = measured.join(ids.distinct(), "doc_id", "left_semi").where("perplexity is not null")
    at = F.percentile_approx("perplexity", F.lit(quantile), F.lit(10_000))
    each = good.groupBy(F.col("lang").alias("__lang")).agg(at.alias("at"), F.count("*").alias("n"))
    each = each.where(F.col("n") >= least).select("__lang", "at")
    whole = good.agg(at.alias("at")).first().at
    joined = measured.join(each, F.col("lang").eqNullSafe(F.col("__lang")), "left")
    limit = F.coalesce("at", F.lit(whole).cast("double"))
    inside = F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    return joined.withColumn("threshold", limit).select(
        "doc_id",
        "lang",
        "n_chars",
        "perplexity",
        "threshold",
        (F.col("perplexity").isNotNull() & inside).alias("kept"),
    )
