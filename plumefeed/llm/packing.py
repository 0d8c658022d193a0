"""Packing by optimal length buckets and token-budget batches.

The global histogram of lengths is small; dynamic programming over it finds the bucket
boundaries with the least padding. Batches then fill up inside each bucket.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..config import materialize


def word_count(text: Column) -> Column:
    """Words between white space; null texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper ends of at most ``buckets`` buckets with the least padding in total.

    ``lengths`` are distinct and ascending. The best start of a bucket never moves down when
    its end moves up, so each layer is solved by halving. Ties go to the earlier start.
    """
    n = len(lengths)
    if n <= buckets:
        return lengths.tolist()
    rows = np.concatenate([[0], np.cumsum(counts)]).astype(float)
    total = np.concatenate([[0], np.cumsum(counts * lengths)]).astype(float)
    # best[j]: least padding of the first j lengths; starts[layer][j]: where the last begins.
    best = np.concatenate([[0.0], lengths * rows[1:] - total[1:]])
    starts = [np.zeros(n + 1, np.int64)]
    for _ in range(1, buckets):
        layer, start = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        layer[0] = 0.0
        todo = [(1, n, 0, n - 1)]
        while todo:
            low, high, first, last = todo.pop()
            if low > high:
                continue
            j = (low + high) // 2
            i = np.arange(first, min(last, j - 1) + 1)
            cost = best[i] + lengths[j - 1] * (rows[j] - rows[i]) - (total[j] - total[i])
            k = int(np.argmin(cost))
            layer[j], start[j] = cost[k], i[k]
            todo += [(low, j - 1, first, int(i[k])), (j + 1, high, int(i[k]), last)]
        best = layer
        starts.append(start)
    ends, j = [], n
    for start in reversed(starts):
        if j:
            ends.append(int(lengths[j - 1]))
            j = int(start[j])
    return ends[::-1]


def pack(
    docs: DataFrame,
    length: Column | None = None,
    buckets: int = 16,
    budget: int = 16_384,
    align: int = 8,
) -> DataFrame:
    """Bucket and batch of every document.

    Returns ``doc_id, n_tokens, bucket, padded_length, batch_id, slot``. Every document of a
    bucket is padded to the bucket's ``padded_length``, a multiple of ``align``; a batch holds
    as many documents as fit ``budget`` padded tokens, one at least. All batches of a bucket
    but its last one are full. Documents go by length, then id, null ids first, at every size
    of the table; rows with the same length and id are alike and take their slots in any order.

    ``length`` is the number of tokens, as a tokenizer counted them before. By default a token
    is a word between white space, and the budget is one of words. Documents
    without tokens, null texts among them, get no bucket, batch and slot. Every row gives a
    row, also with a null or repeated id. Other columns are ignored; an empty table gives an
    empty result.

    The histogram that comes to the driver has one row per distinct padded length. Those add
    up to at most the number of tokens, so there are less than twice its square root.
    """
    tokens = word_count(F.col("text")) if length is None else length.cast("long")
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), tokens.alias("n_tokens"))
    sized = materialize(sized, "lengths")
    padded = F.ceil(F.col("n_tokens") / align) * align
    histogram = (
        sized.where("n_tokens > 0")
        .groupBy(padded.alias("padded"))
        .agg(F.count("*").alias("n"))
        .orderBy("padded")
        .collect()
    )
    values = np.array([r.padded for r in histogram], np.int64)
    counts = np.array([r.n for r in histogram], np.int64)
    ends = best_boundaries(values, counts, buckets)
    spark = docs.sparkSession
    plan, base, begin = [], 0, 0
    for b, end in enumerate(ends):
        stop = int(np.searchsorted(values, end, "right"))
        room = max(1, budget // end)
        plan.append((b, end, room, base))
        base += -(-int(counts[begin:stop].sum()) // room)
        begin = stop
    bounds = spark.createDataFrame(plan, "bucket int, padded_length long, room long, base long")

    below = F.filter(F.array(*[F.lit(e).cast("long") for e in ends]), lambda e: e < F.col("n_tokens"))
    full = sized.where("n_tokens > 0").select(
        "*", (F.size(below) if ends else F.lit(0)).cast("int").alias("bucket")
    )
    # Place in the bucket: rows of the ranges before, and the place in the own range.
    order = ["n_tokens", "doc_id"]
    full = full.repartitionByRange("bucket", *order).withColumn("part", F.spark_partition_id())
    full = materialize(full, "ranged")
    sizes = full.groupBy("bucket", "part").agg(F.count("*").alias("n"))
    ahead = W.partitionBy("bucket").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    before = sizes.select("bucket", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    own = W.partitionBy("bucket", "part").orderBy(*order)
    placed = full.withColumn("place", F.row_number().over(own) - 1)
    placed = placed.join(before, ["bucket", "part"]).join(bounds, "bucket")
    place = F.col("ahead") + F.col("place")
    packed = placed.select(
        "doc_id",
        "n_tokens",
        "bucket",
        "padded_length",
        (F.col("base") + F.floor(place / F.col("room"))).cast("long").alias("batch_id"),
        (place % F.col("room")).cast("int").alias("slot"),
    )
    empty = sized.where("n_tokens <= 0").select(
        "doc_id",
        "n_tokens",
        F.lit(None).cast("int").alias("bucket"),
        F.lit(None).cast("long").alias("padded_length"),
        F.lit(None).cast("long").alias("batch_id"),
        F.lit(None).cast("int").alias("slot"),
    )
    return packed.unionByName(empty)
