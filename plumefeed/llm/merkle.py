"""A Merkle manifest of a table of documents, with a proof for every row.

Native columns and joins only. Every document is a leaf; the leaves of a source form a tree
and the trees' roots, in the order of their sources, form the tree of the data set. Up to
``FAN`` neighbours have one parent.

Places come from counts of range partitions, not from a sort of one source in one task.
Three levels are hashed per shuffle, in groups of at most 27 nodes. Proofs grow by pointer
jumping: a node holds the siblings of the way to its ancestor at distance d; joined with
that ancestor's own way it reaches 2d. After round r only levels that are multiples of
2**r go on, so the tables that are joined to the leaves shrink with the third power.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..config import materialize

FAN = 3
# Levels hashed in one shuffle.
STEP = 3
# An ancestor further away than this is copied once for every FAN**NEAR nodes below it, so
# that no key of a join has more rows than that.
NEAR = 8
# Sizes of full trees; no table has more rows than the last.
SIZES = [FAN**i for i in range(40)]


def leaf_hash(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """Hash of the five fields, each with its length in bytes before it; null is ``-``."""

    def field(c: Column) -> Column:
        value = c.cast("string")
        return F.when(value.isNull(), "-").otherwise(
            F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        )

    return F.sha2(F.concat(*[field(c) for c in (doc_id, source, lang, n_chars, text)]), 256)


def _height(n: Column) -> Column:
    """Levels above the leaves of a tree with ``n`` leaves."""
    return F.size(F.filter(F.array(*[F.lit(s) for s in SIZES]), lambda s: s < n))


def _power(exponent: Column) -> Column:
    return F.get(F.array(*[F.lit(s) for s in SIZES]), exponent)


def placed(table: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``table`` with ``pos``, the place of a row in its group from 0, and ``n``, the group's rows.

    A group may hold most rows: it is cut into ranges of ``order``, and the ranges' counts say
    where each begins. Rows equal in ``order`` get their places in any order.
    """
    ranged = table.repartitionByRange(group, *order).withColumn("part", F.spark_partition_id())
    ranged = materialize(ranged, "ranged")
    counts = ranged.groupBy(group, "part").agg(F.count("*").alias("rows"))
    each = W.partitionBy(group)
    counts = counts.select(
        group,
        "part",
        (F.sum("rows").over(each.orderBy("part")) - F.col("rows")).alias("before"),
        F.sum("rows").over(each).alias("n"),
    )
    counts = materialize(counts, "ranges")
    inside = F.row_number().over(W.partitionBy(group, "part").orderBy(*order)) - 1
    return (
        ranged.join(counts, [group, "part"])
        .withColumn("pos", (F.col("before") + inside).cast("long"))
        .drop("part", "before")
    )


def _hashed(level: Column) -> Column:
    """Parents of the digests of one level."""
    starts = F.sequence(F.lit(0), F.size(level) - 1, F.lit(FAN))
    return F.transform(
        starts,
        lambda i: F.unhex(
            F.sha2(F.array_join(F.transform(F.slice(level, i + 1, FAN), lambda d: F.lower(F.hex(d))), ""), 256)
        ),
    )


def _with_siblings(digests: Column, level: Column, first: Column) -> Column:
    """Nodes of one level of a group, each with its siblings left and right in its run."""

    def node(d: Column, i: Column) -> Column:
        run = i - F.pmod(i, F.lit(FAN))
        side = lambda a, n: F.aggregate(
            F.slice(digests, a + 1, n), F.unhex(F.lit("")), lambda acc, x: F.concat(acc, x)
        )
        return F.struct(
            level.alias("level"),
            (first + i).cast("long").alias("pos"),
            d.alias("digest"),
            F.array(
                F.struct(side(run, i - run).alias("left"), side(i + 1, run + F.lit(FAN - 1) - i).alias("right"))
            ).alias("way"),
        )

    return F.transform(digests, node)


def grow(leaves: DataFrame) -> tuple[DataFrame, int]:
    """All nodes of the trees over ``leaves`` (``tree, pos, n, digest``), and the most levels.

    Returns ``tree, n, level, pos, digest, way``; ``way`` holds the siblings on the way to the
    parent, and is empty at a root.
    """
    most = leaves.agg(F.max("n")).first()[0] or 0
    height = sum(s < most for s in SIZES)
    base = leaves.select("tree", "n", "pos", "digest")
    tables = []
    for low in range(0, max(height, 1), STEP):
        span = FAN**STEP
        block = F.expr(f"pos div {span}")
        groups = base.groupBy("tree", "n", block.alias("block")).agg(
            F.array_sort(F.collect_list(F.struct("pos", "digest"))).alias("own")
        )
        groups = groups.withColumn("d0", F.transform("own", lambda x: x["digest"]))
        none = F.array().cast("array<binary>")
        top = _height(F.col("n"))
        for i in range(1, STEP + 1):
            groups = groups.withColumn(
                f"d{i}", F.when(top >= low + i, _hashed(F.col(f"d{i - 1}"))).otherwise(none)
            )
        levels = [
            _with_siblings(F.col(f"d{i}"), F.lit(low + i), F.col("block") * (span // FAN**i))
            for i in range(STEP + 1)
        ]
        # The last level is the first of the next round, unless a root is reached there.
        levels[STEP] = F.transform(levels[STEP], lambda x: x.withField("way", F.slice(x["way"], 1, 0)))
        nodes = groups.select("tree", "n", F.explode(F.concat(*levels)).alias("x")).select("tree", "n", "x.*")
        is_root = F.col("level") == _height(F.col("n"))
        nodes = nodes.withColumn("way", F.when(is_root, F.slice("way", 1, 0)).otherwise(F.col("way")))
        nodes = materialize(nodes, f"level-{low}")
        base = nodes.where((F.col("level") == low + STEP) & ~is_root)
        tables.append(nodes.where((F.col("level") < low + STEP) | is_root))
    whole = tables[0]
    for t in tables[1:]:
        whole = whole.unionByName(t)
    return whole, height


def roots(nodes: DataFrame) -> DataFrame:
    """``tree, digest`` of every tree."""
    return nodes.where(F.col("level") == _height(F.col("n"))).select("tree", "digest")


def jump(nodes: DataFrame, height: int) -> DataFrame:
    """``tree, pos, way`` of the leaves, the way now leading to the root of the tree."""
    now, half = nodes.select("tree", "n", "level", "pos", "way"), 1
    while half < height:
        stay = F.col("level") % (2 * half) == 0
        chunk = FAN**NEAR if half > NEAR else None
        left = now.where(stay).select(
            "*",
            (F.col("level") + half).alias("to_level"),
            F.expr(f"pos div {FAN**half}").alias("to_pos"),
            (F.expr(f"pos div {chunk}") if chunk else F.lit(0).cast("long")).alias("chunk"),
        )
        right = now.where(~stay & (F.col("level") % half == 0)).select(
            "tree", "n", F.col("level").alias("to_level"), F.col("pos").alias("to_pos"), F.col("way").alias("more")
        )
        if chunk:
            # Chunks of the nodes below, at the level of the left side.
            below = F.col("to_level") - half
            size = F.ceil(F.col("n") / _power(below)).cast("long")
            last = F.least((F.col("to_pos") + 1) * FAN**half, size) - 1
            right = right.withColumn(
                "chunk", F.explode(F.sequence(F.expr(f"to_pos * {FAN**half} div {chunk}"), F.floor(last / chunk)))
            )
        else:
            right = right.withColumn("chunk", F.lit(0).cast("long"))
        key = ["tree", "to_level", "to_pos", "chunk"]
        joined = left.join(right.drop("n"), key, "left")
        more = F.coalesce("more", F.slice("way", 1, 0))
        now = joined.select("tree", "n", "level", "pos", F.concat("way", more).alias("way"))
        now = materialize(now, f"ways-{2 * half}")
        half *= 2
    return now.where("level = 0").select("tree", "n", "pos", "way")


def fold(leaf: Column, way: Column) -> Column:
    """Root that a leaf leads to along the siblings of its way; digests are hex text."""
    text = lambda d: F.lower(F.hex(d))
    return F.aggregate(
        way, leaf, lambda acc, s: F.sha2(F.concat(text(s["left"]), acc, text(s["right"])), 256)
    )


def siblings(way: Column) -> Column:
    """All siblings of a way as hex text, from the leaf up, left to right."""
    return F.array_join(F.transform(way, lambda s: F.lower(F.hex(F.concat(s["left"], s["right"])))), "")


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Leaf, tree roots and proof of every row of ``docs``, and whether it can be verified.

    Returns ``doc_id, source, leaf, subroot, root, way, folded_root, verified``. ``way`` is the
    proof: for every level up to the root the siblings to the left and to the right, 32 bytes
    each. ``tampered`` is the text that verification finds instead of the stored one (none:
    the stored text); the proof is always that of the stored rows.

    Leaves ascend by ``doc_id`` within a source, null ids first; rows with the same id by
    leaf, and rows equal in all fields are leaves of their own at neighbouring places, in any order. A
    null source is a source of its own, before all others. Null and empty fields differ. An
    empty table gives no rows, other columns are ignored.
    """
    spark = docs.sparkSession
    doc_id, n_chars = (F.col(c).cast("long") for c in ("doc_id", "n_chars"))
    source, lang, text = (F.col(c).cast("string") for c in ("source", "lang", "text"))
    found = text if tampered is None else tampered
    digest = lambda t: F.unhex(leaf_hash(doc_id, source, lang, n_chars, t))
    same = found.eqNullSafe(text)
    leaves = docs.select(
        doc_id.alias("doc_id"),
        # Null becomes the empty key, which sorts first.
        F.when(source.isNull(), "").otherwise(F.concat(F.lit("="), source)).alias("key"),
        digest(text).alias("digest"),
        F.when(~same, digest(found)).alias("other"),
    )
    leaves = materialize(placed(materialize(leaves, "leaves"), "key", ["doc_id", "digest"]), "places")
    sources = leaves.groupBy("key").agg(F.first("n").alias("size")).withColumn("all", F.lit(0))
    sources = materialize(placed(sources, "all", ["key"]), "sources")
    # The tree of a source is named by the source's place. Rows of a large source are dealt
    # over the source's chunks, so that this join has no hot key.
    chunk, last = FAN**NEAR, F.col("size") - 1
    numbers = sources.select(
        "key",
        F.col("pos").alias("tree"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / chunk))).alias("chunk"),
    )
    leaves = leaves.withColumn("chunk", F.expr(f"pos div {chunk}")).join(numbers, ["key", "chunk"])
    leaves = materialize(leaves, "trees")

    nodes, height = grow(leaves)
    ways = jump(nodes, height)
    subroots = sources.select(F.lit(0).cast("long").alias("all"), F.col("pos").alias("tree"), "n", "size")
    subroots = materialize(subroots.join(roots(nodes), "tree"), "subroots")
    upper, upper_height = grow(
        subroots.select(F.col("all").alias("tree"), "n", F.col("tree").alias("pos"), "digest")
    )
    upper_ways = jump(upper, upper_height).select(F.col("pos").alias("tree"), F.col("way").alias("rest"))
    root = next((r.digest for r in roots(upper).collect()), None)
    tops = subroots.join(upper_ways, "tree").select(
        "tree",
        F.col("digest").alias("top"),
        "rest",
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / chunk))).alias("chunk"),
    )
    whole = (
        leaves.select("tree", "chunk", "pos", "doc_id", "key", "digest", "other")
        .join(ways.select("tree", "pos", "way"), ["tree", "pos"])
        .join(tops, ["tree", "chunk"])
    )
    hex_ = lambda c: F.lower(F.hex(c))
    whole = whole.select(
        "doc_id",
        F.when(F.col("key") != "", F.expr("substring(key, 2)")).alias("source"),
        hex_(F.col("digest")).alias("leaf"),
        hex_(F.col("top")).alias("subroot"),
        F.lit(None if root is None else bytes(root).hex()).cast("string").alias("root"),
        F.concat("way", "rest").alias("way"),
        fold(hex_(F.coalesce("other", "digest")), F.concat("way", "rest")).alias("folded_root"),
    )
    return whole.withColumn("verified", F.col("folded_root") == F.col("root"))
