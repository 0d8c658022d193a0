"""WordPiece text to ids and back, over a vocabulary table ``(token_id, token)``.

A vocabulary has at most ``MAX_SHARED_TOKENS`` entries, is shared with every task, and both
directions run in place, without a shuffle. ``decode_by_join`` looks ids up by a join whose
frequent ids are spread over salts; it is there to be called, nothing changes over to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import materialize, small_batches
from ..constants import JAVA_WHITESPACE, SPECIAL_TOKENS

MAX_SHARED_TOKENS = 2_000_000
JOIN_SALTS = 16
# Handled at a time inside a task: a token takes the library about a hundred bytes while a
# text is encoded, and about fifty while its id is decoded. Texts are cut at blanks for that.
STEP_BYTES = 1 << 16
STEP_IDS = 1 << 17


def shared_vocab(vocab: DataFrame, limit: int = MAX_SHARED_TOKENS) -> list[str]:
    """The tokens in id order; more than ``limit`` are an error.

    Reads at most ``limit + 1`` rows whatever the size of the table.
    """
    rows = vocab.select("token_id", "token").limit(limit + 1).collect()
    if not rows:
        raise ValueError("the vocabulary is empty")
    if len(rows) > limit:
        raise ValueError(f"the vocabulary has more than {limit} tokens")
    rows.sort(key=lambda r: r.token_id)
    if rows[-1].token_id != len(rows) - 1:
        raise ValueError("vocabulary ids must run from 0 without gaps")
    return [r.token for r in rows]


def _steps(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring rows whose sizes add up to ``most``, one row at least."""
    ends = np.cumsum(sizes)
    row = 0
    while row < len(ends):
        before = ends[row - 1] if row else 0
        last = max(row + 1, int(np.searchsorted(ends, before + most, "right")))
        yield row, last - row
        row = last


def _sizes(lengths: pa.Array) -> np.ndarray:
    return pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False).astype(np.int64)


class _Pieces:
    """Lookup arrays for decoding, built once per Python worker."""

    def __init__(self, tokens: list[str]):
        self.size = len(tokens)
        special = set(SPECIAL_TOKENS)
        self.silent = np.array([t in special for t in tokens], dtype=bool)
        self.tail = np.array([t.startswith("##") for t in tokens], dtype=bool)
        # First half: the piece with its leading space. Second half: without.
        self.text = pa.array(
            [" " + t for t in tokens] + [t[2:] if t.startswith("##") else t for t in tokens],
            pa.string(),
        )

    def decode_all(self, ids: pa.ListArray) -> Iterator[pa.Array]:
        for at, n in _steps(_sizes(pc.list_value_length(ids)), STEP_IDS):
            yield self.decode(ids.slice(at, n))

    def decode(self, ids: pa.ListArray) -> pa.Array:
        flat = pc.list_flatten(ids).to_numpy(zero_copy_only=False)
        row = pc.list_parent_indices(ids).to_numpy(zero_copy_only=False)
        keep = (flat >= 0) & (flat < self.size)
        keep[keep] &= ~self.silent[flat[keep].astype(np.int64)]
        text = self.join(len(ids), row[keep].astype(np.int64), flat[keep].astype(np.int64))
        return pc.if_else(pc.is_valid(ids), text, pa.scalar(None, pa.string()))

    def join(self, rows: int, row: np.ndarray, flat: np.ndarray) -> pa.Array:
        """Texts of ``rows`` rows from the tokens ``flat``, ``row`` naming the row of each."""
        bare = self.tail[flat]
        words = np.flatnonzero(~bare)
        _, first = np.unique(row[words], return_index=True)
        bare = bare.copy()
        bare[words[first]] = True
        offsets = np.zeros(rows + 1, dtype=np.int32)
        np.cumsum(np.bincount(row, minlength=rows), out=offsets[1:])
        pieces = self.text.take(pa.array(flat + bare * self.size))
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), pieces), "")
        return pc.utf8_trim(text, characters=JAVA_WHITESPACE)


def decoder(spark, tokens: list[str]):
    """A function Column(ids) -> Column(text) over a shared vocabulary."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(tokens)

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = _Pieces(shared.value)
        for ids in batches:
            yield from pieces.decode_all(ids)

    # Keeps the planner from running the function once more for a filter on its result.
    return decode.asNondeterministic()


def decode_by_join(df: DataFrame, key: str, ids: str, vocab: DataFrame) -> DataFrame:
    """``(key, text)`` by a join with the vocabulary.

    ``key`` must identify a row. Only the different ids of a row are joined: what they stand
    for meets the row's own list again, so no token travels by itself. A frequent id is
    spread over ``JOIN_SALTS`` join keys, the vocabulary is repeated once per salt. Runs a
    job, as both sides read the ids.
    """
    small_batches(df.sparkSession)
    rows = materialize(df.select(F.col(key).alias("key"), F.col(ids).alias("ids")), "token-ids")
    salt = F.pmod(F.xxhash64("key", "token_id"), F.lit(JOIN_SALTS)).cast("int")
    wanted = rows.select("key", F.explode(F.array_distinct("ids")).alias("token_id"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(JOIN_SALTS - 1)))
    lookup = vocab.select("token_id", "token", salts.alias("salt"))
    found = wanted.withColumn("salt", salt).join(lookup, ["token_id", "salt"])
    found = found.select("key", F.struct("token_id", "token").alias("known"))
    both = rows.unionByName(found, allowMissingColumns=True).groupBy("key")
    groups = both.agg(F.collect_list("ids").alias("ids"), F.collect_list("known").alias("known"))

    @F.arrow_udf("string")
    def spell(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for lists, known in batches:
            sizes = _sizes(pc.list_value_length(known))
            owner = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
            own = _sizes(pc.list_value_length(pc.list_flatten(lists)))
            sizes += np.bincount(owner, own, len(lists)).astype(np.int64)
            for at, n in _steps(sizes, STEP_IDS):
                yield _spell_known(lists.slice(at, n), known.slice(at, n))

    return groups.select(F.col("key").alias(key), spell("ids", "known").alias("text"))


def _spell_known(lists: pa.ListArray, known: pa.ListArray) -> pa.Array:
    """Texts of rows with lists of ids, by each row's own ``(token_id, token)``.

    Lists of one key are read place by place, as their tokens sort.
    """
    entries = pc.list_flatten(known)
    tokens = entries.field("token")
    place = lambda row, ids: row.astype(np.int64) << 32 | ids.astype(np.int64) & 0xFFFFFFFF
    numbers = lambda a: a.to_numpy(zero_copy_only=False)
    keys = place(numbers(pc.list_parent_indices(known)), numbers(entries.field("token_id")))
    order = np.argsort(keys, kind="stable")
    single = pc.list_flatten(lists)
    inner = numbers(pc.list_parent_indices(single)).astype(np.int64)
    row = numbers(pc.list_parent_indices(lists)).astype(np.int64)[inner]
    flat = pc.list_flatten(single)
    there = numbers(pc.is_valid(flat))
    wanted = place(row, numbers(pc.fill_null(flat, 0)))
    spot = np.minimum(np.searchsorted(keys[order], wanted), max(len(keys) - 1, 0))
    hit = there & (keys[order][spot] == wanted) if len(keys) else np.zeros(len(wanted), bool)
    at, row, inner = order[spot[hit]] if len(keys) else spot[hit], row[hit], inner[hit]
    if len(lists) and _sizes(pc.list_value_length(lists)).max() > 1:
        own = _sizes(pc.list_value_length(single))
        first = np.cumsum(own) - own
        position = np.flatnonzero(hit) - first[inner]
        rank = np.empty(len(tokens), np.int64)
        rank[numbers(pc.sort_indices(tokens))] = np.arange(len(tokens))
        by = np.lexsort((rank[at], position, row))
        at, row = at[by], row[by]
    pieces = _Pieces(tokens.to_pylist())
    keep = ~pieces.silent[at]
    return pieces.join(len(lists), row[keep], at[keep])


def encoder(spark, tokens: list[str], max_length: int | None = None, add_special: bool = True):
    """A function Column(text) -> Column(ids): greedy longest match, cased.

    ``max_length`` counts the two special tokens, as in the CSV adapter (128).
    """
    small_batches(spark)
    shared = spark.sparkContext.broadcast(tokens)

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = _tokenizer(shared.value, max_length)
        for texts in batches:
            yield from _encode_all(model, texts, add_special)

    return encode.asNondeterministic()


def _encode_all(model, texts: pa.Array, add_special: bool) -> Iterator[pa.Array]:
    """Ids of all texts, some texts at a time: the library keeps much beside the ids."""
    # The same ids without places in the text, where the library has that.
    run = getattr(model, "encode_batch_fast", model.encode_batch)
    for at, n in _steps(_sizes(pc.binary_length(texts)), STEP_BYTES):
        values = texts.slice(at, n).to_pylist()
        if n == 1 and len(values[0] or "") > STEP_BYTES:
            ids = [_encode_long(model, run, values[0], add_special)]
        else:
            encoded = run([v or "" for v in values], add_special_tokens=add_special)
            ids = [None if v is None else np.array(e.ids, np.int32) for v, e in zip(values, encoded)]
        yield pa.array(ids, type=pa.list_(pa.int32()))


def _pieces_of(text: str) -> Iterator[str]:
    """``text`` cut at blanks into pieces of ``STEP_BYTES`` characters; a longer word stays whole."""
    start = 0
    while len(text) - start > STEP_BYTES:
        end = max(text.rfind(c, start + 1, start + STEP_BYTES) for c in " \n")
        if end < 0:
            later = [text.find(c, start + STEP_BYTES) for c in " \n"]
            end = min((i for i in later if i >= 0), default=len(text))
        yield text[start:end]
        start = end
    yield text[start:]


def _encode_long(model, run, text: str, add_special: bool) -> np.ndarray:
    """Ids of one long text, piece by piece: no token runs over a blank."""
    marks = run([""], add_special_tokens=True)[0].ids if add_special else []
    cut = getattr(model, "truncation", None)
    most = cut["max_length"] - len(marks) if cut else None
    parts, n = [], 0
    for piece in _pieces_of(text):
        parts.append(np.array(run([piece], add_special_tokens=False)[0].ids, np.int32))
        n += len(parts[-1])
        if most is not None and n >= most:
            break
    inner = np.concatenate(parts)[:most]
    return np.concatenate([marks[:1], inner, marks[1:]]).astype(np.int32) if marks else inner


def _tokenizer(tokens: list[str], max_length: int | None):
    import os

    # Spark already runs one task per core.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, models, normalizers, pre_tokenizers, processors

    ids = {t: i for i, t in enumerate(tokens)}
    model = Tokenizer(
        models.WordPiece(ids, unk_token="[UNK]", max_input_chars_per_word=100)
    )
    model.normalizer = normalizers.BertNormalizer(
        clean_text=True, handle_chinese_chars=True, strip_accents=None, lowercase=False
    )
    model.pre_tokenizer = pre_tokenizers.BertPreTokenizer()
    model.post_processor = processors.TemplateProcessing(
        single="[CLS] $A [SEP]",
        special_tokens=[("[CLS]", ids["[CLS]"]), ("[SEP]", ids["[SEP]"])],
    )
    if max_length:
        model.enable_truncation(max_length)
    return model
