"""License notices by an exact set-similarity join of text blocks with templates.

Native columns and joins only. A block is a window of words, wide enough for every template
that is looked for in it; a template is found in a block that holds at least ``threshold`` of
the template's distinct words. Words are ordered
by how many documents hold them, rarest first. A block that meets the threshold must hold
one of the template's first words (prefix filter), must be long enough (length filter), and
behind the first common word enough words must be left on both sides (positional filter).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import materialize

# Phrases whose words must stand in a row, and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
# Sentences of published license notices, and their labels.
TEMPLATES = (
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files",
    ),
    (
        "apache-2",
        "licensed under the apache license version 2 0 you may not use this file except in "
        "compliance with the license",
    ),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
    ),
    (
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
    ),
    (
        "cc-by",
        "this work is licensed under a creative commons attribution 4 0 international license",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted",
    ),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
# Blocks of 2 * step words begin every step words, so every passage of step + 1 words lies
# within one. Steps are this one, doubled until a template fits.
STEP = 32

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Runs of digits, letters (A-Z in lower case) and non-ASCII characters."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), NOT_WORD)
    return F.filter(parts, lambda w: w != "")


def _places(found: Column, phrase: str) -> Column:
    """Where the phrase stands, as an array; the walk is made only if a rare word occurs."""
    parts = phrase.split()
    last = F.size(found) - len(parts)
    walk = F.filter(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: _all([F.get(found, i + j) == F.lit(p) for j, p in enumerate(parts)]),
    )
    some = _all([F.array_contains(found, p) for p in parts])
    return F.when((last >= 0) & some, walk).otherwise(F.array().cast("array<int>"))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def step_for(template: str) -> int:
    """Distance of the blocks in which a template is looked for."""
    step = STEP
    while step < len(template.split()):
        step *= 2
    return step


def _text_list(values: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(values)), ",")


def scan_licenses(
    docs: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    phrases: tuple[tuple[str, str], ...] = PHRASES,
    threshold: float = 0.8,
) -> DataFrame:
    """Phrases and license notices of every document.

    Returns ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``:
    words, places of phrases, the first and last of them, the phrases' labels, those with
    the templates' added, and the largest share of a template found (1 with a phrase).

    Null and empty texts have no words and no labels. Every row gives a row, also with a null
    or repeated id, and has the labels of its own text. Other columns are ignored. Each
    template needs a word.
    """
    spark = docs.sparkSession
    distinct = [(label, sorted(set(text.split())), step_for(text)) for label, text in templates]
    vocabulary = sorted({w for _, ws, _ in distinct for w in ws})
    known = F.array(*[F.lit(w) for w in vocabulary]) if vocabulary else F.array().cast("array<string>")
    split = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words(F.col("text")).alias("words"))

    # The global order: documents that hold the word, then the word itself. Only the words
    # of templates matter, as no other word is ever in common.
    seen = split.select(F.explode(F.array_intersect("words", known)).alias("word"))
    counted = {r.word: r.n for r in seen.groupBy("word").agg(F.count("*").alias("n")).collect()}
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counted.get(w, 0), w)))}
    rows, prefixes = [], []
    for number, (label, ws, step) in enumerate(distinct):
        order = sorted(rank[w] for w in ws)
        need = math.ceil(threshold * len(order) - 1e-9)
        rows.append((number, label, order, need, step))
        prefixes += [(number, r, i, step) for i, r in enumerate(order[: len(order) - need + 1])]
    wanted = spark.createDataFrame(rows, "template int, label string, ranks array<int>, need int, step int")
    wanted = wanted.drop("step")
    prefix = spark.createDataFrame(prefixes, "template int, rank int, t_at int, step int")
    # A document without any word of a prefix has no block to look at.
    by_rank = sorted(rank, key=rank.get)
    first_words = [F.lit(by_rank[r]) for r in sorted({p[1] for p in prefixes})]
    if first_words:
        hopeful = F.arrays_overlap("words", F.array(*first_words))
        table = F.create_map(*[F.lit(x) for w in vocabulary for x in (w, rank[w])])
    else:
        hopeful, table = F.lit(False), F.create_map().cast("map<string,int>")

    def blocks_of(step: int) -> Column:
        def block(i: Column) -> Column:
            inside = F.array_intersect(F.slice("words", i + 1, 2 * step), known)
            ranks = F.array_sort(F.transform(inside, lambda w: F.element_at(table, w)))
            return F.struct(F.lit(step).alias("step"), i.alias("at"), ranks.alias("ranks"))

        starts = F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(step))
        least = min(r[3] for r in rows if r[4] == step)
        return F.filter(F.transform(starts, block), lambda b: F.size(b["ranks"]) >= least)

    empty = F.array().cast("array<struct<step: int, at: int, ranks: array<int>>>")
    blocks = F.concat(empty, *[blocks_of(step) for step in sorted({r[4] for r in rows})])
    places = [_places(F.col("words"), p).alias(f"p{i}") for i, (p, _) in enumerate(phrases)]
    # Ids may be null or repeated: the rows get numbers of their own, which are written once.
    scanned = split.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        *places,
        F.when(hopeful, blocks).otherwise(empty).alias("blocks"),
    )
    scanned = materialize(scanned, "scanned")

    in_blocks = scanned.where(F.size("blocks") > 0).select("row", F.explode("blocks").alias("b"))
    in_blocks = in_blocks.select("row", "b.step", "b.at", F.col("b.ranks").alias("own"))
    common = in_blocks.select("*", F.posexplode("own").alias("b_at", "rank")).join(prefix, ["rank", "step"])
    first = common.groupBy("row", "at", "own", "template").agg(
        F.min(F.struct("t_at", "b_at")).alias("first")
    )
    left = F.least(
        F.size("ranks") - F.col("first.t_at"), F.size("own") - F.col("first.b_at")
    )
    pairs = first.join(wanted, "template").where((F.size("own") >= F.col("need")) & (left >= F.col("need")))
    shared = F.size(F.array_intersect("own", "ranks"))
    found = pairs.withColumn("shared", shared).where("shared >= need")
    by_row = found.groupBy("row").agg(
        F.collect_set("label").alias("more"), F.max(F.col("shared") / F.size("ranks")).alias("share")
    )

    starts_of = F.flatten(F.array(*[F.col(f"p{i}") for i in range(len(phrases))]))
    labels = F.array(
        *[F.when(F.size(f"p{i}") > 0, F.lit(label)) for i, (_, label) in enumerate(phrases)]
    )
    base = scanned.select(
        "row",
        "doc_id",
        "n_words",
        F.size(starts_of).cast("long").alias("n_base"),
        F.array_min(starts_of).cast("long").alias("first_word"),
        F.array_max(starts_of).cast("long").alias("last_word"),
        F.filter(labels, lambda x: x.isNotNull()).alias("base"),
    )
    joined = base.join(by_row, "row", "left")
    more = F.coalesce("more", F.array().cast("array<string>"))
    return joined.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        _text_list(F.col("base")).alias("base_labels"),
        _text_list(F.concat("base", more)).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
