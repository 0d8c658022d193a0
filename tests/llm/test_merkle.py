"""Trees and proofs against plain Python, forged rows, odd rows, large and small trees."""

import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from plumefeed.llm import merkle
from plumefeed.llm.oracle import MERKLE_SQL

TABLE = "doc_id long, text string, lang string, source string, n_chars long, tree string, pos string, n string, key string, level string, way string, chunk string, digest string, part string"


def table(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 9) for r in rows], TABLE)


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h("".join(map(field, (doc_id, source, lang, n_chars, text))))


def climb(level):
    """Root of a tree, and for each leaf its siblings from the bottom up."""
    ways, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for i, way in enumerate(ways):
            run = at[i] // 3 * 3
            way.append(("".join(level[run : at[i]]), "".join(level[at[i] + 1 : run + 3])))
            at[i] //= 3
        level = [h("".join(level[i : i + 3])) for i in range(0, len(level), 3)]
    return level[0], ways


def plain(rows, change=lambda r: r[1]):
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
    trees = {s: climb([leaf(*r) for r in groups[s]]) for s in order}
    root, tops = climb([trees[s][0] for s in order])
    out = []
    for s, top in zip(order, tops):
        for r, way in zip(groups[s], trees[s][1]):
            acc = leaf(r[0], change(r), *r[2:])
            for left, right in way + top:
                acc = h(left + acc + right)
            proof = "".join(a + b for a, b in way + top)
            out.append((r[0], s, leaf(*r), trees[s][0], root, proof, acc, acc == root))
    return sorted(out, key=repr)


def found(df):
    proof = merkle.siblings(F.col("way")).alias("proof")
    columns = ["doc_id", "source", "leaf", "subroot", "root", proof, "folded_root", "verified"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("near", [1, 8])
def test_equals_plain_trees(spark, monkeypatch, near):
    """One source holds most rows; sizes around powers of three; ancestors copied or not."""
    monkeypatch.setattr(merkle, "NEAR", near)
    rng = random.Random(5)
    sizes = {"big": 800, "b": 1, "c": 2, "d": 3, "e": 4, "ä": 27, None: 28, "": 82}
    rows, ids = [], rng.sample(range(10**6), 1000)
    for source, n in sizes.items():
        for _ in range(n):
            i = ids.pop()
            rows.append((i, f"text {i}\nof {source}", rng.choice(["en", None]), source, i % 7 or None))
    rng.shuffle(rows)
    changed = F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    got = found(merkle.manifest(table(spark, rows), changed))
    expected = plain(rows, lambda r: r[1] + "!" if r[0] % 3 == 0 else r[1])
    assert got == expected
    assert {r[-1] for r in got} == {True, False}


def test_every_forgery_is_found(spark):
    """A row whose text is not the stored one leads to another root, all others to the root."""
    rows = [(i, f"row {i}", "en", f"s{i % 4}", 5) for i in range(60)]
    for forged in (0, 31, 59):
        text = F.when(F.col("doc_id") == forged, F.lit("forged")).otherwise(F.col("text"))
        got = merkle.manifest(table(spark, rows), text).collect()
        assert [r.doc_id for r in got if not r.verified] == [forged]


def test_odd_rows(spark, odd, odd_rows, nothing):
    rows = [(i, t, lang, "src", None if t is None else len(t)) for i, t, lang in odd_rows]
    assert found(merkle.manifest(odd)) == plain(rows)
    assert merkle.manifest(nothing).collect() == []
    single = [(7, None, None, None, None)]
    got = found(merkle.manifest(table(spark, single)))
    assert got == plain(single) and got[0][5] == "" and got[0][-1]


def test_odd_rows_equal_sql(spark, odd):
    from plumefeed.llm import queries

    docs = odd.select("doc_id", "source", "lang", "n_chars", "text").toArrow()
    db = duckdb.connect()
    db.register("documents", docs)
    expected = sorted(db.execute(MERKLE_SQL).fetchall(), key=repr)
    changed = F.when(
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False)),
        F.regexp_replace("text", "\n", ""),
    ).otherwise(F.col("text"))
    proof = F.sha2(merkle.siblings(F.col("way")), 256)
    got = merkle.manifest(odd, changed).select(
        "doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified"
    )
    assert "op13_merkle_manifest" in queries.ORACLE
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected
