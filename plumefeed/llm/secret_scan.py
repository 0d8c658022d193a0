"""Secrets by a trigram index: Boolean trigram queries choose the texts each rule reads.

A query of trigrams that every match must contain is derived from each rule's pattern. Each
piece of a batch gets an inverted index of the trigrams that the queries name; intersecting
and uniting its postings gives the candidates, which the pattern then verifies. A rule
without mandatory trigrams reads every text.
"""

from __future__ import annotations

import hashlib
import re
import re._constants as sre
import re._parser as parser
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import map_rows, slices, text_buffers

# Strings that a stretch of a pattern may stand for before it is cut.
MAX_STRINGS = 64
MAX_CLASS = 8


@dataclass(frozen=True)
class Rule:
    """Leftmost matches of ``pattern``; they count if ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
        any_case=True,
    ),
    # A run of these characters is matched whole, so its least length can stand in the pattern.
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# Published token formats.
FORMATS = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"sk_live_[0-9A-Za-z]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN (RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----"),
)
RULES = BASE + FORMATS

# A query is True (no demand), a trigram, or ("and" | "or", parts).
Query = bool | bytes | tuple


def _both(parts: list[Query]) -> Query:
    parts = [p for p in dict.fromkeys(parts) if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _either(parts: list[Query]) -> Query:
    parts = list(dict.fromkeys(parts))
    return True if True in parts or not parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _of_strings(strings: set[str]) -> Query:
    """What any text with one of the strings must contain."""
    raw = sorted(s.encode("utf-8") for s in strings)
    return _either([_both([r[i : i + 3] for i in range(len(r) - 2)]) for r in raw])


def _strings(op, value) -> set[str] | None:
    """All strings one node of a pattern stands for, in lower case; None if too many."""
    if op is sre.LITERAL:
        return {chr(value).lower() if value < 128 else chr(value)}
    if op is sre.IN and all(o is sre.LITERAL for o, _ in value):
        found = {s for o, v in value for s in _strings(o, v)}
        return found if len(found) <= MAX_CLASS else None
    if op is sre.SUBPATTERN:
        return _sequence(value[3])
    if op is sre.BRANCH:
        each = [_sequence(branch) for branch in value[1]]
        return None if None in each else set().union(*each)
    if op is sre.MAX_REPEAT and value[:2] == (0, 1):
        inner = _sequence(value[2])
        return None if inner is None else inner | {""}
    return None


def _sequence(nodes) -> set[str] | None:
    found = {""}
    for op, value in nodes:
        more = _strings(op, value)
        if more is None or len(found) * len(more) > MAX_STRINGS:
            return None
        found = {a + b for a in found for b in more}
    return found


def _query(nodes) -> Query:
    parts: list[Query] = []
    run = {""}
    for op, value in nodes:
        more = _strings(op, value)
        if more is not None and len(run) * len(more) <= MAX_STRINGS:
            run = {a + b for a in run for b in more}
            continue
        parts.append(_of_strings(run))
        run = more if more is not None else {""}
        if more is not None:
            continue
        if op is sre.SUBPATTERN:
            parts.append(_query(value[3]))
        elif op is sre.BRANCH:
            parts.append(_either([_query(branch) for branch in value[1]]))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[0] > 0:
            parts.append(_query(value[2]))
    return _both([*parts, _of_strings(run)])


def trigram_query(rule: Rule) -> Query:
    """The trigrams, in lower case, without which ``rule`` cannot match."""
    return _query(parser.parse(rule.pattern, re.ASCII))


def _trigrams(query: Query) -> set[bytes]:
    if isinstance(query, bytes):
        return {query}
    return set() if query is True else set().union(*(_trigrams(p) for p in query[1]))


def _number(trigram: bytes) -> int:
    return trigram[0] << 16 | trigram[1] << 8 | trigram[2]


class TrigramIndex:
    """Postings of the wanted trigrams over the texts of one piece of a batch."""

    def __init__(self, text: pa.Array, wanted: np.ndarray):
        """``wanted`` flags trigrams by number."""
        data, at = text_buffers(text)
        self.size = len(text)
        self.postings: dict[int, np.ndarray] = {}
        if len(data) < 3:
            return
        lower = data + ((data >= 0x41) & (data <= 0x5A)).astype(np.uint8) * 32
        codes = lower[:-2].astype(np.int32) << 16
        codes |= lower[1:-1].astype(np.int32) << 8
        codes |= lower[2:]
        hits = np.flatnonzero(wanted[codes])
        row = np.searchsorted(at, hits, "right") - 1
        inside = hits + 3 <= at[row + 1]
        pairs = np.unique(codes[hits[inside]].astype(np.int64) << 32 | row[inside])
        numbers, begin = np.unique(pairs >> 32, return_index=True)
        lists = np.split(pairs & 0xFFFFFFFF, begin[1:]) if len(numbers) else []
        self.postings = dict(zip(numbers.tolist(), lists))

    def rows(self, query: Query) -> np.ndarray:
        """Texts that satisfy the query."""
        if query is True:
            return np.arange(self.size)
        if isinstance(query, bytes):
            return self.postings.get(_number(query), np.empty(0, np.int64))
        found = None
        for part in query[1]:
            rows = self.rows(part)
            if found is None:
                found = rows
            elif query[0] == "and":
                found = np.intersect1d(found, rows, assume_unique=True)
            else:
                found = np.union1d(found, rows)
        return found


def _scan(
    batches: Iterator[pa.RecordBatch], rules: tuple[Rule, ...]
) -> Iterator[tuple[pa.RecordBatch, list[str], list[list[tuple[int, int, int]]]]]:
    """Pieces of the batches, their texts, and ``start, rule, end`` of each one's secrets."""
    queries = [trigram_query(r) for r in rules]
    patterns = [r.compiled() for r in rules]
    wanted = np.zeros(1 << 24, bool)
    for query in queries:
        wanted[[_number(t) for t in _trigrams(query)]] = True
    for batch, text in slices(batches):
        index = TrigramIndex(text, wanted)
        texts = text.to_pylist()
        found: list[list] = [[] for _ in texts]
        for number, (rule, query, pattern) in enumerate(zip(rules, queries, patterns)):
            for i in index.rows(query).tolist():
                for m in pattern.finditer(texts[i]):
                    a, b = m.span(rule.group)
                    if b - a >= rule.least:
                        found[i].append((m.start(), number, m.end()))
        yield batch, texts, [sorted(f) for f in found]


def find_secrets(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, name: str = "secrets"
) -> DataFrame:
    """``docs`` with a column of secrets: an array of ``kind, start, end`` in code points.

    Spans go by start, then in the order of the rules; ends are exclusive. Null and empty
    texts have none. Every row gives a row. A column of the input called ``name`` is
    replaced, all others are kept.
    """
    docs = docs.drop(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, found in _scan(batches, rules):
            spans = [[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in f] for f in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(spans, kind)], names=[*batch.schema.names, name]
            )

    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    span = F.lit(None).cast("array<struct<kind: string, start: int, end: int>>")
    return map_rows(docs, run, docs.limit(0).withColumn(name, span).schema)


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret replaced by ``mark``; overlapping spans get one mark.

    Where a text changes, a column ``n_chars`` is set to its new length. Null texts stay
    null; rows without secrets stay as they are.
    """
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts, found in _scan(batches, rules):
            columns = dict(zip(names, batch.columns))
            changed = [i for i, f in enumerate(found) if f]
            if changed:
                out = columns["text"].to_pylist()
                for i in changed:
                    parts, at = [], 0
                    for a, _, b in found[i]:
                        if a >= at:
                            parts += [texts[i][at:a], mark]
                        at = max(at, b)
                    out[i] = "".join([*parts, texts[i][at:]])
                columns["text"] = pa.array(out, columns["text"].type)
                if "n_chars" in columns:
                    sizes = columns["n_chars"].to_pylist()
                    for i in changed:
                        sizes[i] = len(out[i])
                    columns["n_chars"] = pa.array(sizes, columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    return map_rows(docs, run, docs.schema)


def digest(found: DataFrame, base: tuple[Rule, ...] = BASE) -> DataFrame:
    """Counts and digests of the base kinds, and all spans as text, of each document."""
    text = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    kinds = F.transform("secrets", lambda s: s["kind"])
    own = F.filter("secrets", lambda s: s["kind"].isin([r.kind for r in base]))
    number = lambda kind: F.size(kinds) - F.size(F.array_remove(kinds, kind))
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[number(r.kind).cast("long").alias(f"n_{r.kind}") for r in base],
        F.sha2(F.array_join(F.transform(own, text), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("secrets", text), ",").alias("spans"),
    )
