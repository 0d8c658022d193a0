"""Near-duplicate classes by a multi-index Hamming join of b-bit MinHash signatures.

A signature has ``CHUNKS * WIDTH`` symbols of 16 bits, each the hash of a permutation's
minimum. Two signatures that differ in less than ``CHUNKS * (ERRORS + 1)`` symbols have, by
the pigeonhole principle, a chunk with at most ``ERRORS`` wrong symbols. Every choice of
wrong symbols is enumerated per chunk and the remaining ones form a key, so all pairs under
that distance share a key. Pairs with a shared key are confirmed on the full sets.

Sets of a similarity of 0.8 share a key except in about one of 600,000 cases.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import materialize
from .textops import (
    constants,
    fetch,
    list_array,
    map_rows,
    mix,
    non_space,
    shingle_sets,
    signed,
    slices,
    words_of,
)

CHUNKS, WIDTH, ERRORS = 10, 5, 1
SYMBOLS = CHUNKS * WIDTH
PLANES = 4
# Words of 64 bits of a set's parity sketch.
PARITY = 16
# At a similarity of 0.8 some 9 symbols differ, give or take 3. A hub is tried only with
# members that differ in at most this many; the last round compares what the hubs left out.
PROMISING = 24
HUB_ROUNDS = 2

_PLANE = [f"p{i}" for i in range(PLANES)]
_ODD = [f"odd{i}" for i in range(PARITY)]
_PRINT = "doc_id long, n_shingles long, d1 long, d2 long, sig binary, " + ", ".join(
    f"{c} long" for c in (*_PLANE, *_ODD)
)


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Symbols of each set; sets must not be empty."""
    at = np.zeros(len(sets), np.int64)
    np.cumsum([len(s) for s in sets[:-1]], out=at[1:])
    flat = np.concatenate(sets)
    out = np.empty((len(sets), SYMBOLS), np.uint64)
    for k, (a, b) in enumerate(zip(constants(21, SYMBOLS), constants(22, SYMBOLS))):
        out[:, k] = np.minimum.reduceat(flat * a + b, at)
    return (mix(out) & np.uint64(0xFFFF)).astype(np.uint16)


def _planes(symbols: np.ndarray) -> list[np.ndarray]:
    """Bit i of every symbol, packed into one integer per set."""
    place = np.uint64(1) << np.arange(SYMBOLS, dtype=np.uint64)
    return [
        (((symbols >> i) & 1).astype(np.uint64) * place).sum(axis=1, dtype=np.uint64)
        for i in range(PLANES)
    ]


def _parities(sets: list[np.ndarray]) -> np.ndarray:
    """For each bit of a sketch, whether an odd number of the set's members fall on it.

    Two sketches never differ in more bits than the sets differ in members, so sets too far
    apart can be told without being read.
    """
    width = 64 * PARITY
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    spot = (np.concatenate(sets) >> np.uint64(40)).astype(np.int64) % width
    odd = np.bincount(row * width + spot, minlength=len(sets) * width).astype(np.uint8) & 1
    return np.packbits(odd.reshape(len(sets), width), axis=1).view(np.int64)


def _digests(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over each set that tell sets apart."""
    one = [mix(s).sum(dtype=np.uint64) for s in sets]
    two = [mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) for s in sets]
    return np.array(one, np.uint64), np.array(two, np.uint64)


def prints(docs: DataFrame, width: int) -> DataFrame:
    """Size, digest and signature of every document's shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, text in slices(batches):
            sets = shingle_sets(words_of(text, non_space()), width)
            full = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
            symbols = np.zeros((len(sets), SYMBOLS), np.uint16)
            if len(full):
                symbols[full] = _signatures([sets[i] for i in full])
            d1, d2 = _digests(sets)
            odd = _parities(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(signed(d1)),
                    pa.array(signed(d2)),
                    pa.array([row.tobytes() for row in symbols], pa.binary()),
                    *[pa.array(signed(p)) for p in _planes(symbols)],
                    *[pa.array(odd[:, i]) for i in range(PARITY)],
                ],
                names=["doc_id", "n_shingles", "d1", "d2", "sig", *_PLANE, *_ODD],
            )

    return map_rows(docs.select("doc_id", "text"), run, _PRINT)


def _chunk_keys(reps: DataFrame) -> DataFrame:
    """``(key, doc_id)`` for every chunk and every choice of wrong symbols in it."""
    left = [list(c) for c in combinations(range(WIDTH), WIDTH - ERRORS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = constants(31, WIDTH)
        salts = mix(np.arange(1, CHUNKS * len(left) + 1, dtype=np.uint64))
        for batch in batches:
            raw = b"".join(batch.column("sig").to_pylist())
            symbols = np.frombuffer(raw, np.uint16).reshape(-1, CHUNKS, WIDTH).astype(np.uint64)
            keys = np.empty((len(symbols), CHUNKS, len(left)), np.uint64)
            for j, picked in enumerate(left):
                # Four symbols of 16 bits fill the key exactly; the salt tells chunks apart.
                packed = symbols[:, :, picked] << np.arange(
                    0, 16 * len(picked), 16, dtype=np.uint64
                )
                keys[:, :, j] = np.bitwise_or.reduce(packed, axis=2)
            keys = mix(keys.reshape(len(symbols), -1) + salts) * factors[0]
            ids = np.repeat(batch.column("doc_id").to_numpy(), keys.shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(keys.ravel())), pa.array(ids)], names=["key", "doc_id"]
            )

    return map_rows(reps.select("doc_id", "sig"), run, "key long, doc_id long")


def _near_sizes(a: str, b: str, threshold: float) -> Column:
    """Whether the sizes of a pair leave a chance of the threshold."""
    sizes = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    return F.least(*sizes) >= threshold * F.greatest(*sizes)


def _promising(a: str, b: str) -> Column:
    """Whether the signatures of a pair are so near that a hub should be tried."""
    differ = F.lit(0).cast("long")
    for c in _PLANE:
        differ = differ.bitwiseOR(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}")))
    return F.bit_count(differ) <= PROMISING


def _near_parity(a: str, b: str, threshold: float) -> Column:
    """Whether the parity sketches differ in no more bits than the sets' members may."""
    members = F.col(f"{a}.n_shingles") + F.col(f"{b}.n_shingles")
    differ = F.lit(0)
    for c in _ODD:
        differ = differ + F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}")))
    return differ <= members * ((1 - threshold) / (1 + threshold)) + 1e-6


def _confirmed(
    pairs: DataFrame, docs: DataFrame, marks: DataFrame, width: int, percent: int
) -> DataFrame:
    """Pairs ``(a, b)`` whose full sets meet the threshold."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    ids = materialize(ids.join(marks, "doc_id"), "wanted")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, text in slices(batches):
            found = shingle_sets(words_of(text, non_space()), width)
            same = signed(_digests(found)[0]) == batch.column("d1").to_numpy()
            keep = np.flatnonzero(same)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(keep)),
                    list_array([signed(found[i]) for i in keep], pa.int64()),
                ],
                names=["doc_id", "members"],
            )

    texts = fetch(docs.select(F.col("doc_id").cast("long"), "text"), ids)
    full = map_rows(texts, sets, "doc_id long, members array<long>")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = []
            for name in ("left_set", "right_set"):
                column = batch.column(name)
                at = column.offsets.to_numpy()
                flat = column.values.to_numpy()
                lists.append([flat[x:y] for x, y in zip(at[:-1], at[1:])])
            good = []
            for i, (x, y) in enumerate(zip(*lists)):
                shared = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * shared >= percent * (len(x) + len(y) - shared):
                    good.append(i)
            yield batch.select(["a", "b"]).take(pa.array(good, pa.int64()))

    lefts = full.select(F.col("doc_id").alias("a"), F.col("members").alias("left_set"))
    rights = full.select(F.col("doc_id").alias("b"), F.col("members").alias("right_set"))
    both = pairs.join(lefts, "a").join(rights, "b").select("a", "b", "left_set", "right_set")
    return map_rows(both, compare, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(doc_id, comp)`` for every end of a link: the smallest id reachable.

    Each round points every id at its smallest neighbour, follows the pointer once more
    and contracts the links; each round's tables are written, so none is recomputed.
    """
    edges = materialize(links.select("a", "b").where("a <> b").distinct(), "edges")
    labels = None
    while labels is None or not edges.isEmpty():
        ends = edges.union(edges.select("b", "a"))
        down = ends.groupBy("a").agg(F.min("b").alias("to"))
        down = materialize(down.select("a", F.least("a", "to").alias("to")), "down")
        far = down.select(F.col("a").alias("to"), F.col("to").alias("far"))
        jump = materialize(down.join(far, "to").select("a", F.col("far").alias("to")), "jump")
        if labels is None:
            labels = jump.select(F.col("a").alias("doc_id"), F.col("to").alias("comp"))
        else:
            moved = jump.select(F.col("a").alias("comp"), "to")
            labels = labels.join(moved, "comp", "left").select(
                "doc_id", F.coalesce("to", "comp").alias("comp")
            )
        labels = materialize(labels, "labels")
        one = edges.join(jump, "a").select(F.col("to").alias("x"), "b")
        two = one.join(jump.select(F.col("a").alias("b"), F.col("to").alias("y")), "b")
        smaller, larger = F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")
        edges = materialize(two.where("x <> y").select(smaller, larger).distinct(), "edges")
    return labels


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Class of every document under Jaccard similarity of ``width``-word shingles.

    Returns ``doc_id, n_shingles, component_id, kept``: set size, smallest id reachable over
    links of at least ``percent`` per cent, and whether that is the document itself.

    Equal sets are one representative from the start. Each bucket of a key first links its
    members to one hub, so a group of many near copies costs one pair a member; only buckets
    that still hold several components then compare across components, all of them.

    Null, empty and blank texts have an empty set and are linked with nothing. Rows with a
    null id are left out. Rows that repeat an id count once; of different texts under one id
    the set with the smallest digest counts. Other columns are ignored, whatever their names.
    An empty table gives an empty result.
    """
    threshold = percent / 100
    docs = docs.where(F.col("doc_id").isNotNull())
    every = materialize(prints(docs, width), "prints")
    fields = [c for c in every.columns if c != "doc_id"]
    once = every.groupBy("doc_id").agg(F.min(F.struct("d1", *[c for c in fields if c != "d1"])).alias("one"))
    once = materialize(once.select("doc_id", *[F.col(f"one.{c}") for c in fields]), "once")

    same = ["d1", "d2", "n_shingles"]
    classes = once.where("n_shingles > 0").groupBy(*same).agg(F.min("doc_id").alias("rep"))
    classes = materialize(classes, "classes")
    members = once.select("doc_id", *same).join(classes, same, "left")
    heads = classes.select(F.col("rep").alias("doc_id"))
    reps = materialize(once.join(heads, "doc_id", "left_semi"), "reps")
    traits = ["n_shingles", *_PLANE]
    marks = reps.select("doc_id", "d1")

    keys = _chunk_keys(reps)
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    buckets = keys.join(shared, "key", "left_semi").join(reps.select("doc_id", *traits), "doc_id")
    buckets = materialize(buckets, "buckets")

    labels = buckets.select("doc_id").distinct().withColumn("comp", F.col("doc_id"))
    labels = materialize(labels, "labels")
    links = tested = None
    for step in range(HUB_ROUNDS + 1):
        placed = buckets.join(labels, "doc_id")
        hub = F.min(F.struct("comp", "doc_id", *traits)).alias("hub")
        spans = placed.groupBy("key").agg(hub, F.max("comp").alias("top"))
        spans = spans.where("hub.comp <> top")
        met = (F.col("x.key") == F.col("y.key")) & (F.col("x.comp") < F.col("y.comp"))
        met = met & _near_sizes("x", "y", threshold)
        if step < HUB_ROUNDS:
            met = met & _promising("x", "y")
            x, y = spans.select("key", "hub.*").alias("x"), placed.alias("y")
        else:
            # What is left after the hubs: all pairs across components that share a key. Only
            # sizes and parities cut some of them, which loses no link.
            left = placed.join(spans.select("key"), "key", "left_semi")
            left = materialize(left.join(reps.select("doc_id", *_ODD), "doc_id"), "open")
            x, y = left.alias("x"), left.alias("y")
            met = met & _near_parity("x", "y", threshold)
        found = x.join(y, met).select(
            F.least("x.doc_id", "y.doc_id").alias("a"),
            F.greatest("x.doc_id", "y.doc_id").alias("b"),
            F.col("y.doc_id").alias("member"),
        )
        if step < HUB_ROUNDS and tested is None:
            # One hub a member and round: the others are taken when it fails.
            best = F.min(F.struct("a", "b")).alias("pair")
            found = found.groupBy("member").agg(best).select("pair.a", "pair.b").distinct()
        else:
            found = found.select("a", "b").distinct()
            if tested is not None:
                found = found.join(tested, ["a", "b"], "left_anti")
        found = materialize(found, "pairs")
        if found.isEmpty():
            if step < HUB_ROUNDS:
                continue
            break
        good = materialize(_confirmed(found, docs, marks, width, percent), "links")
        tested = found if tested is None else tested.unionByName(found)
        links = good if links is None else links.unionByName(good)
        if good.isEmpty():
            continue
        comps = components(links)
        known = buckets.select("doc_id").distinct().join(comps, "doc_id", "left")
        labels = known.select("doc_id", F.coalesce("comp", "doc_id").alias("comp"))
        labels = materialize(labels, "labels")

    labels = labels.select(F.col("doc_id").alias("rep"), "comp")
    component = F.coalesce("comp", "rep", "doc_id").alias("component_id")
    out = members.join(labels, "rep", "left").select("doc_id", "n_shingles", component)
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id.

    Rows with a null id stay; rows that repeat an id count once, and the one with the
    smallest text stays.
    """
    gone = near_duplicates(docs, width, percent).where("not kept").select("doc_id")
    left = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    repeated = docs.groupBy("doc_id").agg(F.count("*").alias("__n"))
    repeated = repeated.where("doc_id is not null and __n > 1").select("doc_id")
    if repeated.isEmpty():
        return left
    again = left.join(repeated, "doc_id", "left_semi")
    first = F.min(F.struct("text", *[c for c in docs.columns if c not in ("doc_id", "text")]))
    again = again.groupBy("doc_id").agg(first.alias("__one"))
    again = again.select(
        *[F.col(c) if c == "doc_id" else F.col(f"__one.{c}").alias(c) for c in docs.columns]
    )
    return left.join(repeated, "doc_id", "left_anti").unionByName(again)
