"""SQL of the newer queries, written apart from the operators, for a single-node database."""

# Trees, proofs and the way back to the root by recursion, level by level. The checksum is
# made bit by bit, as there is no function for it.
MERKLE_SQL = """
WITH RECURSIVE fields AS (
  SELECT row_number() OVER () AS k, doc_id, source, lang, n_chars, text,
    list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
      string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
      lambda c, b: xor(xor(c, b) >> 1, 3988292384::BIGINT * (xor(c, b) & 1))) AS crc
  FROM documents),
texts AS (
  SELECT k, doc_id, source,
    list_transform([CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR)],
      lambda v: coalesce(octet_length(encode(v)) || ':' || v, '-')) AS head, text,
    CASE WHEN doc_id IS NOT NULL AND xor(crc, 4294967295::BIGINT) % 2 = 0
      THEN replace(text, chr(10), '') ELSE text END AS found
  FROM fields),
leaves AS (
  SELECT k, doc_id, source,
    sha256(array_to_string(head, '') || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
    sha256(array_to_string(head, '') || coalesce(octet_length(encode(found)) || ':' || found, '-')) AS other
  FROM texts),
places AS (
  SELECT *, count(*) OVER (PARTITION BY source) AS n,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, k) - 1 AS pos
  FROM leaves),
sources AS (
  SELECT source, n, row_number() OVER (ORDER BY source IS NOT NULL, encode(source)) - 1 AS tree,
    count(*) OVER () AS trees
  FROM (SELECT DISTINCT source, n FROM places)),
nodes(tree, level, pos, n, digest) AS (
  SELECT s.tree, 0, p.pos, p.n, p.leaf FROM places p JOIN sources s ON p.source IS NOT DISTINCT FROM s.source
  UNION ALL
  SELECT tree, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 3, n),
subroots AS (SELECT tree, digest FROM nodes WHERE n = 1),
upper_nodes(level, pos, n, digest) AS (
  SELECT 0, s.tree, s.trees, r.digest FROM sources s JOIN subroots r USING (tree)
  UNION ALL
  SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM upper_nodes WHERE n > 1 GROUP BY level, pos // 3, n),
root AS (SELECT digest FROM upper_nodes WHERE n = 1),
heights AS (SELECT tree, max(level) AS height FROM nodes GROUP BY tree),
all_nodes AS (
  SELECT tree, level, pos, digest FROM nodes WHERE n > 1
  UNION ALL SELECT -1, level, pos, digest FROM upper_nodes WHERE n > 1),
runs AS (
  SELECT a.tree, a.level, a.pos,
    coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM all_nodes a JOIN all_nodes b
    ON a.tree = b.tree AND a.level = b.level AND a.pos // 3 = b.pos // 3
  GROUP BY a.tree, a.level, a.pos),
steps AS (
  SELECT p.k, r.level AS step, r.l, r.r
  FROM places p JOIN sources s ON p.source IS NOT DISTINCT FROM s.source
  JOIN heights h USING (tree)
  JOIN runs r ON r.tree = s.tree AND r.pos = p.pos // CAST(pow(3, r.level) AS BIGINT)
  UNION ALL
  SELECT p.k, h.height + r.level, r.l, r.r
  FROM places p JOIN sources s ON p.source IS NOT DISTINCT FROM s.source
  JOIN heights h USING (tree)
  JOIN runs r ON r.tree = -1 AND r.pos = s.tree // CAST(pow(3, r.level) AS BIGINT)),
proofs AS (SELECT k, sha256(string_agg(l || r, '' ORDER BY step)) AS proof FROM steps GROUP BY k),
walk(k, step, digest) AS (
  SELECT k, 0, other FROM places
  UNION ALL
  SELECT w.k, w.step + 1, sha256(s.l || w.digest || s.r)
  FROM walk w JOIN steps s ON w.k = s.k AND w.step = s.step),
folded AS (SELECT k, arg_max(digest, step) AS digest FROM walk GROUP BY k)
SELECT p.doc_id, p.leaf, u.digest AS subroot, root.digest AS root,
  coalesce(q.proof, sha256('')) AS proof_sha256, f.digest AS folded_root, f.digest = root.digest AS verified
FROM places p JOIN sources s ON p.source IS NOT DISTINCT FROM s.source
JOIN subroots u USING (tree) JOIN folded f USING (k) LEFT JOIN proofs q USING (k) CROSS JOIN root
"""

# All pairs of anchors and rows.
HARD_NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS anchor_id, d.vec_id, q.label = d.label AS same,
    CAST(list_sum(list_transform(list_zip(q.e, d.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0),
good AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INT) AS rank,
  s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM good JOIN scores s USING (anchor_id)
WHERE NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
QUALIFY rank <= 3
"""


def ngram_bands_sql(order: int = 5) -> str:
    """Counts, the whole model over lists of characters, and the bands, without blocks or shards."""
    levels = ""
    for n in range(order - 1, 0, -1):
        levels += f"""
l{n} AS (SELECT substr(g, 2) AS g, CAST(count(*) AS BIGINT) AS n FROM l{n + 1} GROUP BY 1),"""
    probs = """
p0 AS (SELECT 1.0::DOUBLE / (count(*) + 1)::DOUBLE AS p FROM l1),"""
    for k in range(1, order + 1):
        low = "JOIN p0 b ON true" if k == 1 else f"JOIN p{k - 1} b ON b.g = substr(l.g, 2)"
        probs += f"""
t{k} AS (
  SELECT count(*) FILTER (n = 1)::DOUBLE AS t1, count(*) FILTER (n = 2)::DOUBLE AS t2,
    count(*) FILTER (n = 3)::DOUBLE AS t3, count(*) FILTER (n = 4)::DOUBLE AS t4 FROM l{k}),
d{k} AS (
  SELECT CASE WHEN t1 > 0 AND t2 > 0 THEN least(greatest(1 - 2 * y * t2 / t1, 0.1::DOUBLE), 1) ELSE 0.5::DOUBLE END AS d1,
    CASE WHEN t2 > 0 AND t3 > 0 THEN least(greatest(2 - 3 * y * t3 / t2, 0.1::DOUBLE), 2) ELSE 1::DOUBLE END AS d2,
    CASE WHEN t3 > 0 AND t4 > 0 THEN least(greatest(3 - 4 * y * t4 / t3, 0.1::DOUBLE), 3) ELSE 1.5::DOUBLE END AS d3
  FROM (SELECT *, CASE WHEN t1 > 0 AND t2 > 0 THEN t1 / (t1 + 2 * t2) ELSE 0.5::DOUBLE END AS y FROM t{k})),
c{k} AS (
  SELECT substr(g, 1, {k - 1}) AS h, sum(n)::DOUBLE AS total,
    (count(*) FILTER (n = 1)::DOUBLE * any_value(d1) + count(*) FILTER (n = 2)::DOUBLE * any_value(d2)
      + count(*) FILTER (n >= 3)::DOUBLE * any_value(d3)) / sum(n)::DOUBLE AS rest
  FROM l{k}, d{k} GROUP BY 1),
p{k} AS (
  SELECT l.g, l.n, (l.n::DOUBLE - CASE l.n WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END) / total + rest * b.p AS p
  FROM l{k} l JOIN c{k} c ON c.h = substr(l.g, 1, {k - 1}) JOIN d{k} ON true {low}),"""
    worth = "(SELECT CAST(round(log2(p) * 1024) AS BIGINT) FROM p0)"
    joins = ""
    for k in range(1, order + 1):
        worth = f"coalesce(w{k}.w, coalesce(v{k}.w, 0) + {worth})"
        joins += f"""
  LEFT JOIN (SELECT g, CAST(round(log2(p) * 1024) AS BIGINT) AS w FROM p{k}{' WHERE n > 1' if k > 1 else ''}) w{k} ON w{k}.g = substr(a.g, {order + 1 - k})
  LEFT JOIN (SELECT h, CAST(round(log2(rest) * 1024) AS BIGINT) AS w FROM c{k} WHERE total > 1) v{k} ON v{k}.h = substr(a.g, {order + 1 - k}, {k - 1})"""
    return f"""
WITH rows_ AS (
  SELECT row_number() OVER () AS k, doc_id, lang, coalesce(text, '') AS text FROM documents),
texts AS (
  SELECT *, length(text) AS n_chars,
    list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words,
    coalesce(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
      string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
      lambda c, b: xor(xor(c, b) >> 1, 3988292384::BIGINT * (xor(c, b) & 1))), 0) AS crc
  FROM rows_),
tokens AS (
  SELECT k, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM texts WHERE len(words) >= 8),
windows AS (
  SELECT k, i, {' || '.join(['word', *(f"' ' || lead(word, {j}) OVER v" for j in range(1, 8))])} AS w
  FROM tokens WINDOW v AS (PARTITION BY k ORDER BY i)),
repeated AS (
  SELECT k, count(DISTINCT spot) AS n FROM (
    SELECT k, unnest(generate_series(i, i + 7)) AS spot
    FROM (SELECT k, i, count(*) OVER (PARTITION BY k, w) AS times FROM windows WHERE w IS NOT NULL) WHERE times > 1)
  GROUP BY k),
lines AS (
  SELECT k, count(*) - count(DISTINCT line) AS n
  FROM (SELECT k, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY k),
facts AS (
  SELECT k, doc_id, lang, n_chars, len(words)::BIGINT AS n_words,
    length(array_to_string(words, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
    doc_id IS NOT NULL AND xor(crc, 4294967295::BIGINT) % 5 = 0 AS held,
    len(list_filter(words, lambda w: regexp_matches(w, '[A-Za-z\\x{{80}}-\\x{{10FFFF}}]'))) AS spelled,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS capitals,
    length(regexp_replace(text, '[^A-Za-z\\x{{80}}-\\x{{10FFFF}}]', '', 'g')) AS letters
  FROM texts LEFT JOIN lines l USING (k) LEFT JOIN repeated r USING (k)),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 10 * n_symbols <= n_words
      AND 10 * spelled >= 8 * n_words AND 10 * capitals <= 3 * letters AS prose
  FROM facts),
chars AS (SELECT k, unnest(string_split(text, '')) AS c, generate_subscripts(string_split(text, ''), 1) AS i
  FROM texts WHERE n_chars > 0),
grams AS (
  SELECT k, {' || '.join(f"coalesce(lag(c, {b}) OVER w, chr(1114111))" for b in range(order - 1, 0, -1))} || c AS g
  FROM chars WINDOW w AS (PARTITION BY k order BY i)),
places AS (SELECT k, g, count(*) AS times FROM grams GROUP BY ALL),
l{order} AS (
  SELECT g, CAST(count(*) AS BIGINT) AS n FROM places JOIN judged USING (k) WHERE prose AND NOT held GROUP BY g),{levels}{probs}
asked AS (SELECT DISTINCT g FROM places),
worth AS (
  SELECT a.g, {worth} AS w FROM asked a{joins}),
scores AS (
  SELECT k, CAST(-sum(times * w) AS BIGINT) * 1000 // (CAST(sum(times) AS BIGINT) * 1024) AS millibits
  FROM places JOIN worth USING (g) GROUP BY k),
measured AS (SELECT * FROM judged LEFT JOIN scores USING (k)),
ends AS (
  SELECT lang, millibits, 0.002 AS share, 'low' AS name FROM measured WHERE prose
  UNION ALL SELECT lang, millibits, 0.995, 'high' FROM measured WHERE prose AND held),
each AS (
  SELECT name, lang, min(millibits) AS m FROM (
    SELECT *, row_number() OVER (PARTITION BY name, lang order BY millibits) AS r,
      count(*) OVER (PARTITION BY name, lang) AS n FROM ends)
  WHERE n >= 50 AND r >= greatest(ceil(n * share), 1) GROUP BY name, lang),
whole AS (
  SELECT name, min(millibits) AS m FROM (
    SELECT *, row_number() OVER (PARTITION BY name order BY millibits) AS r,
      count(*) OVER (PARTITION BY name) AS n FROM ends)
  WHERE r >= greatest(ceil(n * share), 1) GROUP BY name)
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(
    millibits >= coalesce(a.m, (SELECT m FROM whole WHERE name = 'low'))
    AND millibits <= coalesce(b.m, (SELECT m FROM whole WHERE name = 'high')), true) AS kept
FROM measured m
LEFT JOIN each a ON a.name = 'low' AND a.lang IS NOT DISTINCT FROM m.lang
LEFT JOIN each b ON b.name = 'high' AND b.lang IS NOT DISTINCT FROM m.lang
"""
