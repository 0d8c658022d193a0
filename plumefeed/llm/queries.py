"""Registered queries of the operators here, each over its whole table, and SQL for some."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    kneser_ney,
    knn_join,
    language_spans,
    license_scan,
    merkle,
    minhash,
    ngram_bands,
    packing,
    rtree,
    secret_scan,
    spaced_seeds,
    token_counts,
    toxicity,
)
from .license_scan import LOWER, UPPER
from .oracle import HARD_NEGATIVES_SQL, MERKLE_SQL, ngram_bands_sql
from .textops import held_out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return spaced_seeds.overlaps(docs, items)


def op2_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    spans = language_spans.label_spans(docs, language_spans.learn(docs))
    return spans.select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans")
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.digest(secret_scan.find_secrets(docs))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_knn_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn_join.knn_join(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return kneser_ney.judge_quality(docs, labels.where("quality = 1"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score(docs.select("doc_id", "text"), toxicity.learn(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op11_ngram_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = ngram_bands.judge(table(spark, sf_dir, "documents"), stable=True)
    return judged.select("doc_id", *ngram_bands.FACTS, "base_failed", "kept")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rtree.hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    odd_one = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    tampered = F.when(odd_one, F.regexp_replace("text", "\n", "")).otherwise(F.col("text"))
    proved = merkle.manifest(docs, tampered)
    proof = F.sha2(merkle.siblings(F.col("way")), 256).alias("proof_sha256")
    return proved.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified")


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_language_spans": op2_language_spans,
    "op3_token_counts": op3_token_counts,
    "op4_license_scan": op4_license_scan,
    "op5_secret_scan": op5_secret_scan,
    "op6_packing": op6_packing,
    "op7_knn_join": op7_knn_join,
    "op8_quality": op8_quality,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_toxicity": op10_toxicity,
    "op11_ngram_bands": op11_ngram_bands,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_merkle_manifest": op13_merkle_manifest,
}

def license_sql(templates=license_scan.TEMPLATES) -> str:
    """Every template against every block of its size in the same row, without any filter."""
    phrases = ", ".join(f"('{p}', '{label}')" for p, label in license_scan.PHRASES)
    listed = ", ".join(f"('{text}', '{label}', {license_scan.step_for(text)})" for label, text in templates)
    return f"""
WITH w AS (
  SELECT row_number() OVER () AS k, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'),
    lambda x: x <> '') AS words FROM documents),
phrases(phrase, label) AS (VALUES {phrases}),
templates(words, label, step) AS (
  SELECT list_distinct(string_split(t, ' ')), l, s FROM (VALUES {listed}) v(t, l, s)),
places AS (
  SELECT k, label, i - 1 AS pos
  FROM w, phrases, unnest(generate_series(1, len(w.words))) AS g(i)
  WHERE w.words[i : i + len(string_split(phrase, ' ')) - 1] = string_split(phrase, ' ')),
base AS (
  SELECT k, count(*) AS n, min(pos) AS lo, max(pos) AS hi,
         list_sort(list_distinct(list(label))) AS labels FROM places GROUP BY k),
blocks AS (
  SELECT k, step, list_distinct(words[i + 1 : i + 2 * step]) AS own
  FROM w, (SELECT DISTINCT step FROM templates), unnest(generate_series(0, greatest(len(words) - 1, 0), step)) AS g(i)),
shares AS (
  SELECT k, label, len(list_intersect(own, t.words)) / len(t.words) AS share
  FROM blocks JOIN templates t USING (step)),
found AS (
  SELECT k, list(label) AS labels, max(share) AS share FROM shares
  WHERE share >= 0.8 - 1e-9 GROUP BY k)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, coalesce(base.n, 0) AS n_base,
  CAST(base.lo AS BIGINT) AS first_word, CAST(base.hi AS BIGINT) AS last_word,
  coalesce(array_to_string(base.labels, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(
    coalesce(base.labels, []), coalesce(found.labels, [])))), ','), '') AS labels,
  CASE WHEN base.n > 0 THEN 1.0 ELSE coalesce(found.share, 0.0) END::DOUBLE AS score
FROM w LEFT JOIN base USING (k) LEFT JOIN found USING (k)
"""


KNN_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id,
    CAST(list_sum(list_transform(list_zip(q.e, d.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 100 = 0),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank
  FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

NEAR_DUPLICATES_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN []
    WHEN len(words) = 1 THEN [words[1]]
    ELSE list_distinct(list_transform(generate_series(1, len(words) - 1),
      lambda i: words[i] || ' ' || words[i + 1])) END AS own
  FROM w),
members AS (SELECT doc_id, unnest(own) AS shingle FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sets x ON a = x.doc_id JOIN sets y ON b = y.doc_id
  WHERE 100 * n >= 80 * (len(x.own) + len(y.own) - n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT a, b FROM both_ways UNION SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON r.other = l.a),
least AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
SELECT s.doc_id, CAST(len(s.own) AS BIGINT) AS n_shingles,
  least(s.doc_id, coalesce(l.other, s.doc_id)) AS component_id,
  s.doc_id = least(s.doc_id, coalesce(l.other, s.doc_id)) AS kept
FROM sets s LEFT JOIN least l USING (doc_id)
"""

ORACLE: dict[str, str] = {
    "op4_license_scan": license_sql(),
    "op7_knn_join": KNN_SQL,
    "op9_near_duplicates": NEAR_DUPLICATES_SQL,
    "op11_ngram_bands": ngram_bands_sql(),
    "op12_hard_negatives": HARD_NEGATIVES_SQL,
    "op13_merkle_manifest": MERKLE_SQL,
}
