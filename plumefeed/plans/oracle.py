"""Independent SQL for the registered queries, run by DuckDB on the same tables.

The SQL states results from the tables directly; it shares no step with the jobs.
"""

from __future__ import annotations

DIM = 64
EPOCH = 1704067200
AS_OF = 1706745600
SPECIALS = "['[PAD]', '[UNK]', '[CLS]', '[SEP]', '[MASK]']"

def _fill(template: str, **parts: str) -> str:
    for name, text in parts.items():
        template = template.replace(f"@{name}@", text)
    return template


# --- shared pieces --------------------------------------------------------------------

_POST_TIME = f"({EPOCH} + (doc_id * 7919) % 2592000)"

_UUID = """
uuids AS (
  SELECT tweetId, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-'
      || translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h, 18, 3)
      || '-' || substr(h, 21, 12) AS point_id
  FROM (SELECT tweetId, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(tweetId)) AS h
        FROM @ids@))"""

_DOC_IDS = "(SELECT CAST(doc_id AS VARCHAR) AS tweetId FROM documents)"

# Words as the tokenizer sees them: runs without blanks or punctuation, and each
# punctuation mark by itself.
_MARK = r"!-/:-@\[-`{-~\p{P}"
_TOKENS = rf"regexp_extract_all(text, '[{_MARK}]|[^\s{_MARK}]+')"

_VOCAB = f"""
chars AS (SELECT DISTINCT unnest(string_split(regexp_replace(text, '\\s', '', 'g'), '')) AS c FROM documents),
vocab AS (
  SELECT CAST(row_number() OVER (ORDER BY n, token) - 1 AS INTEGER) AS token_id, token
  FROM (SELECT unnest(range(5)) AS n, unnest({SPECIALS}) AS token
        UNION ALL SELECT 5, c FROM chars WHERE c <> ''
        UNION ALL SELECT 5, '##' || c FROM chars WHERE c <> ''))"""

# Token ids of {source}(doc_id, text): one row per document.
_ENCODED = f"""
words AS (
  SELECT doc_id, unnest(w) AS w, unnest(range(len(w))) AS wpos
  FROM (SELECT doc_id, {_TOKENS} AS w FROM @source@)),
pieces AS (
  SELECT doc_id, wpos, 0 AS cpos, '[UNK]' AS token FROM words WHERE length(w) > 100
  UNION ALL
  SELECT doc_id, wpos, i, CASE WHEN i = 0 THEN '' ELSE '##' END || substring(w, CAST(i + 1 AS BIGINT), 1)
  FROM (SELECT *, unnest(range(length(w))) AS i FROM words WHERE length(w) <= 100)
  UNION ALL SELECT doc_id, -1, 0, '[CLS]' FROM @source@
  UNION ALL SELECT doc_id, 1000000000, 0, '[SEP]' FROM @source@),
encoded AS (
  SELECT doc_id, list(token_id ORDER BY wpos, cpos) AS ids
  FROM pieces JOIN vocab USING (token) GROUP BY doc_id)"""

_DECODED = f"array_to_string(list_filter({_TOKENS}, lambda w: length(w) <= 100), ' ')"

# Records as they should come out of the damaged lines: the first broken rule names the
# reason, every thirteenth line is there twice.
_RECORDS = f"""
records AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS tweetId, {_DECODED} AS text, lang AS language,
    CASE WHEN lang = 'en' THEN 'TopLevel' ELSE 'Quote' END AS tweetType,
    {_POST_TIME} AS tweetTimestamp, substr(sha256(source), 1, 32) AS authorId,
    CASE WHEN doc_id % 41 = 0 THEN 0 ELSE n_chars END AS authorFollowerCount,
    lang || '|' || source AS hashtags, n_chars % 2 = 0 AS hasMedia,
    CASE WHEN doc_id % 37 = 0 THEN 'too few columns'
         WHEN doc_id % 17 = 0 THEN 'blank tweet_id'
         WHEN doc_id % 19 = 0 THEN 'token is not a number'
         WHEN doc_id % 23 = 0 THEN 'blank language'
         WHEN doc_id % 31 = 0 THEN 'tweet_timestamp is not a number'
         WHEN doc_id % 29 = 0 THEN 'tweet_timestamp is not positive'
         WHEN length({_DECODED}) < 3 THEN 'text too short' END AS reason,
    unnest(CASE WHEN doc_id % 13 = 0 THEN [1, 2] ELSE [1] END) AS copy
  FROM documents)"""

_CLEAN_COLUMNS = (
    "tweetId, text, language, tweetType, tweetTimestamp, authorId, authorFollowerCount, "
    "hashtags, hasMedia"
)

# The export rows, with the values they stand for.
_EXPORT = f"""
export AS (
  SELECT doc_id, text, lang, source, n_chars,
    CASE WHEN doc_id % 17 = 0
         THEN substr(sha256('brightdata-row-' || doc_id || '-' || text_clean), 1, 32)
         ELSE CAST(doc_id AS VARCHAR) END AS tweet_id,
    text_clean,
    CASE doc_id % 5 WHEN 0 THEN [lang, source] WHEN 1 THEN [lang, source] WHEN 2 THEN []
      WHEN 3 THEN [source] ELSE ['[''' || lang || '''', '''' || source || ''']'] END AS tags,
    array_to_string(list_concat(CASE WHEN doc_id % 3 = 0 THEN ['Photo'] ELSE [] END,
                                CASE WHEN doc_id % 2 = 0 THEN ['Video'] ELSE [] END), '|') AS media,
    'https://example.com/' || doc_id AS links,
    CASE WHEN doc_id % 7 IN (0, 3, 5, 6) THEN 'Reply' WHEN doc_id % 3 = 1 THEN 'Quote'
         ELSE 'TopLevel' END AS tweet_type,
    CASE WHEN doc_id % 29 = 0 THEN {AS_OF}
         WHEN doc_id % 7 = 0 THEN {_POST_TIME} - 10800
         WHEN doc_id % 5 = 0 THEN {_POST_TIME} - {_POST_TIME} % 86400
         ELSE {_POST_TIME} END AS ts,
    substr(sha256(CASE WHEN doc_id % 22 = 0 THEN 'unknown' WHEN doc_id % 11 = 0 THEN 'Name ' || source
                       ELSE source END), 1, 32) AS author,
    CASE WHEN doc_id % 3 = 2 THEN 0 ELSE n_chars END AS followers,
    CASE doc_id % 5 WHEN 0 THEN 1900 WHEN 1 THEN -7 WHEN 4 THEN n_chars ELSE 0 END AS following,
    doc_id % 4 <> 1 AS verified
  FROM (SELECT *, trim(text, E' \\t\\n\\r') AS text_clean FROM documents)
  WHERE text_clean <> '')"""

# Signed word counts of {source}(k, text), scaled to length one, as floats.
_HASHED = f"""
hashed_words AS (
  SELECT k, w, md5(w) AS h FROM (
    SELECT k, unnest(string_split_regex(text, '[ \\t\\n\\r\\f\\v]+')) AS w FROM @source@)
  WHERE w <> ''),
sums AS (
  SELECT k, CAST('0x' || substr(h, 1, 8) AS BIGINT) % {DIM} AS component,
    sum(CASE WHEN substr(h, 9, 1) < '8' THEN 1 ELSE -1 END) AS s
  FROM hashed_words GROUP BY 1, 2),
unit AS (
  SELECT k, component, CAST(s / sqrt(sum(s * s) OVER (PARTITION BY k)) AS FLOAT) AS x
  FROM (SELECT k, component, CAST(s AS DOUBLE) AS s FROM sums) WHERE s <> 0)"""

# Given vectors, else the hashed words of the text.
_POINTS = f"""
{_fill(_UUID, ids=_DOC_IDS)},
doc_vectors AS (
  SELECT k AS hashed_id, list(component ORDER BY component) AS cs, list(CAST(x AS DOUBLE) ORDER BY component) AS xs
  FROM (WITH d AS (SELECT doc_id AS k, text FROM documents
                   WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)),
        {_fill(_HASHED, source="d")} SELECT * FROM unit) GROUP BY k),
points AS (
  SELECT point_id, tweetId, text, lang AS language, {_POST_TIME} AS tweetTimestamp,
    substr(sha256(source), 1, 32) AS authorId, lang || '|' || source AS hashtags,
    CASE WHEN embedding IS NOT NULL THEN CAST(embedding AS DOUBLE[]) ELSE
      list_transform(range({DIM}), lambda c: coalesce(xs[list_position(cs, c)], 0.0::DOUBLE)) END AS emb
  FROM documents LEFT JOIN embeddings ON doc_id = vec_id LEFT JOIN doc_vectors ON doc_id = hashed_id
  JOIN uuids ON tweetId = CAST(doc_id AS VARCHAR))"""

# Mean of vectors(userId, embedding), at most 50 each, scaled to length one.
_MEAN = f"""
means AS (
  SELECT userId, i, avg(CAST(embedding[i] AS DOUBLE)) AS m, count(*) AS n
  FROM vectors, range(1, {DIM + 1}) AS t(i) GROUP BY userId, i),
profiles AS (
  SELECT userId, any_value(n) AS n, list(CAST(m / len AS FLOAT) ORDER BY i) AS profile
  FROM (SELECT *, sqrt(sum(m * m) OVER (PARTITION BY userId)) AS len FROM means)
  WHERE n <= 50 AND len >= 1e-9 GROUP BY userId)"""

_INTERESTS = """
vectors AS (
  SELECT user_id || '/' || event_type AS userId, vec_id, embedding
  FROM events JOIN embeddings ON vec_id = event_id % (SELECT count(*) FROM embeddings))"""

_HITS = """
hits AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY userId ORDER BY cosine DESC, point_id) AS r
    FROM (
      SELECT userId, point_id, round(list_inner_product(p, emb)
          / (sqrt(list_inner_product(p, p)) * sqrt(list_inner_product(emb, emb))), 9) AS cosine
      FROM (SELECT userId, CAST(profile AS DOUBLE[]) AS p FROM profiles), points))
  WHERE r <= 400)"""

_SCORED = f"""
scored AS (
  SELECT *, row_number() OVER (
      PARTITION BY userId ORDER BY finalScore DESC, cosine DESC, point_id) AS position
  FROM (SELECT *, 0.85::DOUBLE * semanticSimilarity + 0.15::DOUBLE * recencyScore AS finalScore
    FROM (SELECT userId, point_id, cosine,
            greatest(0, least(1, (cosine + 1) / 2)) AS semanticSimilarity,
            CASE WHEN tweetTimestamp <= 0 THEN 0 WHEN tweetTimestamp >= {AS_OF} THEN 1
                 ELSE exp(-(({AS_OF} - tweetTimestamp) / 3600.0::DOUBLE) / 24) END AS recencyScore
          FROM hits JOIN points USING (point_id))))"""

_WORD_LIST = (
    r"list_distinct(list_filter(string_split_regex("
    r"regexp_replace(lower(@text@), '[^\p{L}\p{N}\s]', ' ', 'g'), '\s+'), lambda w: length(w) >= 4))"
)

# Posts whose word sets overlap by at least 0.40, then the greedy walk over neighbour
# lists. Posts without words are neighbours of each other.
_WALK = f"""
wordsets AS MATERIALIZED (SELECT point_id, {_fill(_WORD_LIST, text="text")} AS ws FROM points),
postings AS (SELECT point_id, len(ws) AS n, unnest(ws) AS w FROM wordsets),
pairs AS (
  SELECT a.point_id AS a, b.point_id AS b, count(*) AS both_, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM postings a JOIN postings b ON a.w = b.w AND a.point_id <> b.point_id GROUP BY 1, 2),
near AS (
  SELECT a, b, both_ / CAST(na + nb - both_ AS DOUBLE) AS ratio FROM pairs
  WHERE both_ / CAST(na + nb - both_ AS DOUBLE) >= 0.4
  UNION ALL
  SELECT x.point_id, y.point_id, 1.0 FROM wordsets x, wordsets y
  WHERE len(x.ws) = 0 AND len(y.ws) = 0 AND x.point_id <> y.point_id),
neighbours AS (SELECT a AS point_id, list(b) AS nbrs FROM near GROUP BY a),
walks AS (
  SELECT userId, list({{'kept': [point_id], 'nbrs': coalesce(nbrs, [])}} ORDER BY position) AS items
  FROM scored LEFT JOIN neighbours USING (point_id) GROUP BY userId),
kept AS (
  SELECT userId, unnest(ids) AS point_id, CAST(unnest(range(1, len(ids) + 1)) AS INTEGER) AS rank
  FROM (SELECT userId, list_reduce(items, lambda acc, x:
          CASE WHEN list_has_any(acc.kept, x.nbrs) THEN acc
               ELSE {{'kept': list_concat(acc.kept, x.kept), 'nbrs': acc.nbrs}} END).kept AS ids
        FROM walks))"""

_LIMITS = """
asked AS (
  SELECT user_id || '/' || event_type || '/' || event_id % 3 AS requestId,
    user_id || '/' || event_type AS userId,
    CASE WHEN min(event_id) % 7 <> 0 THEN CAST(min(event_id) % 105 - 2 AS INTEGER) END AS requested
  FROM events GROUP BY user_id, event_type, event_id % 3),
limits AS (
  SELECT *, CAST(least(greatest(coalesce(requested, 20), 1), 100) AS INTEGER) AS lim FROM asked)"""

_BASE = f"{_POINTS}, {_INTERESTS}, {_MEAN}, {_HITS}, {_SCORED}"
_FEED = f"{_BASE}, {_WALK}, {_LIMITS}, feed AS (SELECT requestId, kept.*, @extra@ FROM kept JOIN limits USING (userId) @joins@ WHERE rank <= lim)"
_FEED_IDS = _fill(_FEED, extra="points.tweetId", joins="JOIN points USING (point_id)")

_PHRASES = r"""
phrases AS (
  SELECT conv_id, turn, list_filter(list_transform(string_split_regex(text, '[.!?\n]+'),
      lambda x: trim(x, E' \t\n\r')), lambda x: x <> '') AS phrases
  FROM conversations)"""

# Per conversation the newest turn that gives a profile.
_TURN_PROFILES = f"""
{_PHRASES},
phrase_rows AS (
  SELECT [conv_id, turn, i] AS k, phrases[i] AS text
  FROM (SELECT *, unnest(range(1, len(phrases) + 1)) AS i FROM phrases WHERE len(phrases) <= 50)),
{_fill(_HASHED, source="phrase_rows")},
turn_means AS (
  SELECT k[1] AS conv_id, k[2] AS turn, component, sum(CAST(x AS DOUBLE)) / any_value(len(phrases)) AS m,
    any_value(len(phrases)) AS n
  FROM unit JOIN phrases ON k[1] = conv_id AND k[2] = turn GROUP BY k[1], k[2], component),
turn_unit AS (
  SELECT *, sqrt(sum(m * m) OVER (PARTITION BY conv_id, turn)) AS len FROM turn_means),
turn_profiles AS (
  SELECT conv_id, n, component, CAST(m / len AS FLOAT) AS x
  FROM (SELECT *, max(turn) OVER (PARTITION BY conv_id) AS last FROM turn_unit WHERE len >= 1e-9)
  WHERE turn = last)"""

_MESSAGES = """
messages AS (
  SELECT 'post' AS kind, CAST(doc_id AS VARCHAR) AS key, trim(text, E' \\t\\n\\r') <> '' AS indexable FROM documents
  UNION ALL SELECT 'event', CAST(event_id AS VARCHAR), false FROM events
  UNION ALL SELECT 'turn', conv_id || '/' || turn, false FROM conversations)"""


def _partition(key: str) -> str:
    return f"CAST(CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT) % 3 AS INTEGER)"


_EXPORT_TOKENS = f"""
{_VOCAB},
{_EXPORT},
cleaned AS (SELECT doc_id, text_clean AS text FROM export),
{_fill(_ENCODED, source="cleaned")}"""

_LINE = """concat_ws(chr(9), array_to_string(ids, chr(1)), array_to_string(tags, chr(1)), tweet_id,
    replace(media, '|', chr(1)), links, '', tweet_type, 'und', ts, author, followers, following,
    verified, '0', 'sample-reader', '0', '0', 'false', '0', 'false')"""

_STREAM_POSTS = f"""WITH {_RECORDS}
SELECT DISTINCT {_CLEAN_COLUMNS} FROM records WHERE reason IS NULL"""

# --- the checks -----------------------------------------------------------------------

ORACLE: dict[str, str] = {
    "csv_adapt": f"""WITH {_EXPORT_TOKENS}
SELECT CAST(len(ids) AS INTEGER) AS n_tokens, md5(array_to_string(ids, ',')) AS tokens_md5,
  array_to_string(tags, '|') AS hashtags, tweet_id, media AS present_media, links AS present_links,
  tweet_type, 'und' AS language, ts AS tweet_timestamp, author AS engaged_with_user_id,
  followers AS engaged_with_user_follower_count, CAST(following AS BIGINT) AS engaged_with_user_following_count,
  verified AS engaged_with_user_is_verified, CAST(0 AS BIGINT) AS engaged_with_user_account_creation,
  'sample-reader' AS engaging_user_id, CAST(0 AS BIGINT) AS engaging_user_follower_count,
  CAST(0 AS BIGINT) AS engaging_user_following_count, false AS engaging_user_is_verified,
  CAST(0 AS BIGINT) AS engaging_user_account_creation, false AS engagee_follows_engager
FROM export JOIN encoded USING (doc_id)""",
    "csv_slice": f"""WITH {_EXPORT}, n AS (SELECT count(*) AS n FROM documents)
SELECT tweet_id FROM export, n WHERE doc_id >= n // 10
QUALIFY row_number() OVER (ORDER BY doc_id) <= n // 2""",
    "tsv_encode": f"""WITH {_EXPORT_TOKENS}
SELECT tweet_id, 20 AS n_columns, md5({_LINE}) AS line_md5 FROM export JOIN encoded USING (doc_id)""",
    "tsv_scan": """SELECT key, count(*) AS records FROM (
  SELECT CASE WHEN doc_id % 17 = 0 THEN '  ' ELSE CAST(doc_id AS VARCHAR) END AS key,
    unnest(CASE WHEN doc_id % 13 = 0 THEN [1, 2] ELSE [1] END)
  FROM documents WHERE doc_id % 37 <> 0) GROUP BY key""",
    "list_field_parse": f"""WITH {_EXPORT}
SELECT doc_id, CAST(len(tags) AS INTEGER) AS n_hashtags, array_to_string(tags, '|') AS hashtags, links, media
FROM export""",
    "int_bool_ts_parse": f"""WITH {_EXPORT}
SELECT doc_id, followers, CAST(following AS BIGINT) AS following, verified, ts FROM export""",
    "tweet_type": f"WITH {_EXPORT} SELECT doc_id, tweet_type FROM export",
    "vocab_scan": f"WITH {_VOCAB} SELECT token_id, token FROM vocab",
    "encode_tokens": f"""WITH {_VOCAB}, {_fill(_ENCODED, source="documents")}
SELECT doc_id, CAST(len(ids) AS INTEGER) AS n_tokens, md5(array_to_string(ids, ',')) AS ids_md5 FROM encoded""",
    "decode_tokens": f"SELECT doc_id, {_DECODED} AS text FROM documents",
    "tsv_parse": f"""WITH {_VOCAB}, {_fill(_ENCODED, source="documents")}, {_RECORDS}
SELECT tweetId, CAST(len(ids) AS INTEGER) AS n_tokens, md5(array_to_string(ids, ',')) AS ids_md5, hashtags,
  CASE WHEN hasMedia THEN 'Photo' ELSE '' END AS presentMedia, tweetType, language, tweetTimestamp,
  authorId, authorFollowerCount
FROM records JOIN encoded USING (doc_id) WHERE coalesce(reason, 'text too short') = 'text too short'""",
    "clean_posts": f"WITH {_RECORDS} SELECT {_CLEAN_COLUMNS} FROM records WHERE reason IS NULL",
    "clean_json": f"""WITH {_RECORDS}
SELECT tweetId AS key, CAST(to_json({{'tweetId': tweetId, 'text': text, 'language': language,
  'tweetType': tweetType, 'tweetTimestamp': tweetTimestamp, 'authorId': authorId,
  'authorFollowerCount': authorFollowerCount, 'hashtags': string_split(hashtags, '|'),
  'hasMedia': hasMedia}}) AS VARCHAR) AS value
FROM records WHERE reason IS NULL""",
    "clean_counts": f"""WITH {_RECORDS}
SELECT coalesce(reason, 'accepted') AS outcome, count(*) AS records
FROM (SELECT reason FROM records
      UNION ALL SELECT 'blank line' FROM documents WHERE doc_id % 43 = 0) GROUP BY 1""",
    "reject_reasons": f"""WITH {_VOCAB}, {_fill(_ENCODED, source="documents")}, {_RECORDS},
lines AS (
  SELECT reason, concat_ws(chr(9),
    array_to_string(ids, chr(1)) || CASE WHEN doc_id % 19 = 0 THEN chr(1) || 'abc' ELSE '' END,
    replace(hashtags, '|', chr(1)), CASE WHEN doc_id % 17 = 0 THEN '  ' ELSE tweetId END,
    CASE WHEN hasMedia THEN 'Photo' ELSE '' END, '', '', tweetType,
    CASE WHEN doc_id % 23 = 0 THEN ' ' ELSE language END,
    CASE WHEN doc_id % 31 = 0 THEN 'n/a' WHEN doc_id % 29 = 0 THEN '-5' ELSE CAST(tweetTimestamp AS VARCHAR) END,
    authorId, CASE WHEN doc_id % 41 = 0 THEN 'x' ELSE CAST(authorFollowerCount AS VARCHAR) END,
    '0', 'false', '0', 'reader', '0', '0', 'false', '0')
    || CASE WHEN doc_id % 37 = 0 THEN '' ELSE chr(9) || 'false' END AS line
  FROM records JOIN encoded USING (doc_id) WHERE reason IS NOT NULL)
SELECT md5(line) AS line_md5, reason FROM lines
UNION ALL SELECT md5('   '), 'blank line' FROM documents WHERE doc_id % 43 = 0""",
    "dedup_exact": _STREAM_POSTS,
    "dedup_stream_exact": _STREAM_POSTS,
    # Held back from the first third of the month, and too late by the time they come.
    "dedup_stream_bounded": f"""WITH {_RECORDS}
SELECT DISTINCT {_CLEAN_COLUMNS} FROM records
WHERE reason IS NULL AND NOT (doc_id % 47 = 0 AND tweetTimestamp < {EPOCH + 864000})""",
    "progress_metrics": f"""WITH {_RECORDS},
outcomes AS (
  SELECT reason FROM records UNION ALL SELECT 'blank line' FROM documents WHERE doc_id % 43 = 0)
SELECT count(*) AS input_rows, count(*) FILTER (reason IS NULL) AS accepted,
  count(*) FILTER (reason IS NOT NULL) AS rejected, CAST(0 AS BIGINT) AS late_rows FROM outcomes""",
    "rate_replay": f"""WITH {_RECORDS}
SELECT (SELECT count(*) FROM records) + count(*) AS input_rows FROM documents WHERE doc_id % 43 = 0""",
    "index_gate": f"WITH {_MESSAGES} SELECT kind, key, indexable FROM messages",
    "index_counts": f"""WITH {_MESSAGES}
SELECT kind, count(*) AS consumed, count(*) FILTER (indexable) AS upserted,
  count(*) FILTER (NOT indexable) AS skipped FROM messages GROUP BY kind""",
    "point_ids": f"WITH {_fill(_UUID, ids=_DOC_IDS)} SELECT tweetId, point_id FROM uuids",
    "upsert_latest": f"""WITH {_fill(_UUID, ids="(SELECT DISTINCT CAST(conv_id AS VARCHAR) AS tweetId FROM conversations)")},
newest AS (
  SELECT CAST(conv_id AS VARCHAR) AS tweetId, text FROM conversations WHERE trim(text, E' \\t\\n\\r') <> ''
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY
    CASE role WHEN 'system' THEN 0 WHEN 'user' THEN 1 ELSE 2 END DESC, turn DESC) = 1)
SELECT tweetId, point_id, text, CAST(0 AS BIGINT) AS tweetTimestamp, '' AS language
FROM newest JOIN uuids USING (tweetId)""",
    "upsert_streams": f"""WITH {_fill(_UUID, ids="(SELECT DISTINCT CAST(conv_id AS VARCHAR) AS tweetId FROM conversations)")},
arrived AS (
  SELECT *, CASE role WHEN 'user' THEN 0 WHEN 'assistant' THEN 1 ELSE 2 END AS delivery FROM conversations
  WHERE trim(text, E' \\t\\n\\r') <> '' AND role IN ('user', 'assistant', 'system')),
newest AS (
  SELECT CAST(conv_id AS VARCHAR) AS tweetId, text FROM arrived
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY delivery DESC, turn DESC) = 1)
SELECT tweetId, point_id, text FROM newest JOIN uuids USING (tweetId)""",
    "index_profile": f"""SELECT count(DISTINCT conv_id) AS points, {DIM} AS min_dim, {DIM} AS max_dim, 'cosine' AS metric
FROM conversations WHERE trim(text, E' \\t\\n\\r') <> ''""",
    "embed_hashed": f"""WITH docs AS (SELECT doc_id AS k, text FROM documents), {_fill(_HASHED, source="docs")}
SELECT k AS doc_id, CAST(component AS INTEGER) AS component, round(CAST(x AS DOUBLE), 6) AS weight FROM unit""",
    "interest_clean": f"""WITH {_PHRASES}
SELECT CAST(conv_id AS VARCHAR) AS userId, turn AS submitted_at, array_to_string(phrases, '|') AS interests,
  CASE WHEN len(phrases) = 0 THEN 'no interests' WHEN len(phrases) > 50 THEN 'too many interests' END AS reason
FROM phrases""",
    "profiles": f"""WITH {_INTERESTS}, {_MEAN}
SELECT userId, CAST(n AS INTEGER) AS interestCount, {DIM} AS vectorDim, CAST(i - 1 AS INTEGER) AS component,
  round(CAST(profile[i] AS DOUBLE), 5) AS weight
FROM (SELECT *, unnest(range(1, {DIM + 1})) AS i FROM profiles)""",
    "profile_rejects": f"""SELECT CAST(user_id AS VARCHAR) AS userId, CAST(count(*) AS INTEGER) AS interestCount,
  CASE WHEN count(*) > 50 THEN 0 ELSE {DIM} END AS vectorDim,
  CASE WHEN count(*) > 50 THEN 'too many interests' ELSE 'profile created' END AS message
FROM events GROUP BY user_id""",
    "profile_lengths": f"""WITH {_INTERESTS}
SELECT userId, CAST(count(*) AS INTEGER) AS interestCount,
  CASE WHEN count(*) > 50 THEN 'too many interests' WHEN bool_or(vec_id % 5 = 0) THEN 'vector dimensions differ'
       ELSE 'profile created' END AS message
FROM vectors GROUP BY userId""",
    "profiles_hashed": f"""WITH {_TURN_PROFILES}
SELECT CAST(conv_id AS VARCHAR) AS userId, CAST(n AS INTEGER) AS interestCount, {DIM} AS vectorDim,
  CAST(component AS INTEGER) AS component, round(CAST(x AS DOUBLE), 5) AS weight
FROM turn_profiles WHERE round(CAST(x AS DOUBLE), 5) <> 0""",
    "profile_count": f"WITH {_INTERESTS}, {_MEAN} SELECT count(*) AS profiles FROM profiles",
    "interest_cosine": f"""WITH {_INTERESTS}, {_MEAN}
SELECT userId, vec_id, round(list_inner_product(e, p)
    / (sqrt(list_inner_product(e, e)) * sqrt(list_inner_product(p, p))), 6) AS cosine
FROM (SELECT userId, vec_id, CAST(embedding AS DOUBLE[]) AS e, CAST(profile AS DOUBLE[]) AS p
      FROM vectors JOIN profiles USING (userId))""",
    "knn_topk": f"""WITH {_POINTS}, {_INTERESTS}, {_MEAN}, {_HITS}
SELECT userId, point_id, cosine FROM hits""",
    "approx_recall": f"""WITH {_POINTS}, {_INTERESTS}, {_MEAN}, {_HITS}
SELECT count(DISTINCT userId) AS users, count(*) AS hits, true AS reached FROM hits""",
    "candidate_scores": f"""WITH {_BASE}
SELECT userId, CAST(position AS INTEGER) AS position, point_id, round(semanticSimilarity, 10) AS semanticSimilarity,
  round(recencyScore, 8) AS recencyScore, round(finalScore, 8) AS finalScore FROM scored""",
    "score_functions": f"""
SELECT event_id, round(similarity, 8) AS similarity, round(recency, 8) AS recency,
  round(0.85::DOUBLE * similarity + 0.15::DOUBLE * recency, 8) AS score
FROM (SELECT event_id, greatest(0, least(1, (value / 100 - 1 + 1) / 2)) AS similarity,
        CASE WHEN t <= 0 THEN 0 WHEN t >= {EPOCH + 864000} THEN 1
             ELSE exp(-(({EPOCH + 864000} - t) / 3600.0::DOUBLE) / 24) END AS recency
      FROM (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS t FROM events))""",
    "content_words": f"""
SELECT doc_id, CAST(len(ws) AS INTEGER) AS n_words, array_to_string(list_sort(ws), ' ') AS words
FROM (SELECT doc_id, {_fill(_WORD_LIST, text="text")} AS ws FROM documents)""",
    "jaccard_turns": f"""WITH t AS (SELECT conv_id, turn, {_fill(_WORD_LIST, text="text")} AS ws FROM conversations)
SELECT a.conv_id, a.turn, round(CASE WHEN len(a.ws) = 0 AND len(b.ws) = 0 THEN 1.0::DOUBLE ELSE
  len(list_intersect(a.ws, b.ws)) / CAST(len(list_distinct(list_concat(a.ws, b.ws))) AS DOUBLE) END, 6) AS jaccard
FROM t a JOIN t b ON a.conv_id = b.conv_id AND a.turn = b.turn + 1""",
    "similar_pairs": f"""WITH {_POINTS},
wordsets AS (SELECT point_id, list_sort({_fill(_WORD_LIST, text="text")}) AS ws FROM points),
classes AS (SELECT ws, min(point_id) AS head, count(*) AS posts FROM wordsets GROUP BY ws),
words AS (SELECT head, posts, len(ws) AS n, unnest(ws) AS w FROM classes),
shared AS (
  SELECT a.head AS a, b.head AS b, any_value(a.posts) AS pa, any_value(b.posts) AS pb, count(*) AS c,
    any_value(a.n) AS na, any_value(b.n) AS nb
  FROM words a JOIN words b ON a.w = b.w AND a.head < b.head GROUP BY 1, 2)
SELECT a AS point_id, b AS other_id, pa AS posts, pb AS other_posts,
  round(c / CAST(na + nb - c AS DOUBLE), 6) AS jaccard
FROM shared WHERE c / CAST(na + nb - c AS DOUBLE) >= 0.4""",
    "near_dup_greedy": f"""WITH {_BASE}, {_WALK}
SELECT userId, rank, point_id, round(finalScore, 8) AS finalScore FROM kept JOIN scored USING (userId, point_id)""",
    "near_dup_matches": f"""WITH {_BASE}, {_WALK}
SELECT s.userId, s.point_id, k.point_id AS kept_point_id, round(ratio, 6) AS jaccard
FROM scored s JOIN near ON s.point_id = near.a JOIN kept k ON k.userId = s.userId AND k.point_id = near.b
WHERE NOT EXISTS (SELECT 1 FROM kept x WHERE x.userId = s.userId AND x.point_id = s.point_id)
QUALIFY row_number() OVER (PARTITION BY s.userId, s.point_id ORDER BY k.rank) = 1""",
    "feed": f"""WITH {_fill(_FEED, 
        extra="points.* EXCLUDE (point_id), semanticSimilarity, recencyScore, finalScore",
        joins="JOIN scored USING (userId, point_id) JOIN points USING (point_id)")}
SELECT requestId, userId, rank, tweetId, text, language, tweetTimestamp, authorId, hashtags,
  round(semanticSimilarity, 10) AS semanticSimilarity, round(recencyScore, 8) AS recencyScore,
  round(finalScore, 8) AS finalScore FROM feed""",
    "feed_nested": f"""WITH {_FEED_IDS}
SELECT requestId, userId, CAST(count(*) AS INTEGER) AS count,
  string_agg(rank || ':' || tweetId, ',' ORDER BY rank) AS items
FROM feed GROUP BY requestId, userId""",
    "feed_diff": f"""WITH {_FEED_IDS}
SELECT tweetIds, count(*) AS requests FROM (
  SELECT string_agg(tweetId, '|' ORDER BY tweetId) AS tweetIds FROM feed WHERE rank <= 5 GROUP BY requestId)
GROUP BY tweetIds""",
    "feed_hashed": f"""WITH docs AS (SELECT CAST(doc_id AS VARCHAR) AS tweetId, text, {_POST_TIME} AS tweetTimestamp FROM documents),
{_fill(_UUID, ids="docs")},
doc_vectors AS (
  SELECT k AS tweetId, list(component ORDER BY component) AS cs, list(CAST(x AS DOUBLE) ORDER BY component) AS xs
  FROM (WITH d AS (SELECT tweetId AS k, text FROM docs), {_fill(_HASHED, source="d")} SELECT * FROM unit) GROUP BY k),
points AS (
  SELECT point_id, tweetId, text, tweetTimestamp,
    list_transform(range({DIM}), lambda c: coalesce(xs[list_position(cs, c)], 0.0::DOUBLE)) AS emb
  FROM docs JOIN uuids USING (tweetId) JOIN doc_vectors USING (tweetId)),
profiles AS (
  SELECT CAST(conv_id AS VARCHAR) AS userId,
    list_transform(range({DIM}), lambda c: coalesce(xs[list_position(cs, c)], 0.0::FLOAT)) AS profile
  FROM (SELECT conv_id, list(component ORDER BY component) AS cs, list(x ORDER BY component) AS xs
        FROM (WITH {_TURN_PROFILES} SELECT * FROM turn_profiles) GROUP BY conv_id)),
{_HITS}, {_SCORED}, {_WALK}
SELECT userId, rank, tweetId, round(finalScore, 8) AS finalScore
FROM kept JOIN scored USING (userId, point_id) JOIN points USING (point_id) WHERE rank <= 20""",
    "feed_missing_profile": f"""WITH {_INTERESTS}, {_MEAN}
SELECT c_custkey || '/purchase' AS userId, 'no_profile' AS status FROM customer
WHERE c_custkey || '/purchase' NOT IN (SELECT userId FROM profiles)""",
    "feed_limits": f"""WITH {_LIMITS} SELECT requestId, requested, lim AS "limit" FROM limits""",
    "partition_counts": f"""WITH {_RECORDS},
keys AS (
  SELECT 'posts.raw' AS topic, CASE WHEN doc_id % 17 = 0 THEN '  ' ELSE tweetId END AS key
  FROM records WHERE coalesce(reason, '') <> 'too few columns'
  UNION ALL SELECT 'posts.cleaned', tweetId FROM records WHERE reason IS NULL AND copy = 1)
SELECT topic, coalesce(p, -1) AS partition, count(*) AS messages
FROM (SELECT topic, {_partition("key")} AS p FROM keys) GROUP BY ROLLUP (topic, p) HAVING topic IS NOT NULL""",
    "consumer_lag": f"""
SELECT 'events' AS topic, p AS partition, CASE WHEN p < 2 THEN 0 ELSE 1 END AS worker, count(*) AS end_offset,
  count(*) FILTER (epoch(ts) < {EPOCH + 1728000}) AS committed,
  count(*) FILTER (epoch(ts) >= {EPOCH + 1728000}) AS lag
FROM (SELECT ts, {_partition("CAST(user_id AS VARCHAR)")} AS p FROM events) GROUP BY p""",
    "topic_histogram": "SELECT label, count(*) AS records FROM embeddings GROUP BY label",
}

_PAYLOAD = f"""WITH {_fill(_UUID, ids=_DOC_IDS)}
SELECT point_id, tweetId, text, lang AS language, 'TopLevel' AS tweetType, {_POST_TIME} AS tweetTimestamp,
  substr(sha256(source), 1, 32) AS authorId, n_chars AS authorFollowerCount,
  lang || '|' || source AS hashtags, false AS hasMedia
FROM documents JOIN uuids ON tweetId = CAST(doc_id AS VARCHAR) WHERE trim(text, E' \\t\\n\\r') <> ''"""

ORACLE |= {
    "index_payload": _PAYLOAD,
    "index_stream": _PAYLOAD,
    "decode_tokens_joined": ORACLE["decode_tokens"],
    "knn_topk_cells": ORACLE["knn_topk"],
    "knn_topk_stream": ORACLE["knn_topk"],
}
