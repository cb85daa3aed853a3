"""DuckDB SQL for the operators that SQL can express."""

DECONTAMINATE = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
pat AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS m, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS p
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM bw WHERE len(w) > 0)),
lens AS (SELECT DISTINCT m FROM pat),
hits AS (
  SELECT g.doc_id, g.i, g.m, pat.item_id
  FROM (SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS p
        FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM dw, lens WHERE len(w) >= m)) g
  JOIN pat ON pat.m = g.m AND pat.p = g.p),
words AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + m)) AS k FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hits) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

CHAT = r"""
WITH src AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (
  SELECT *, 4 + 1 + 8 + length(role) + length(text)
         + length(role) - length(translate(role, '\#<' || chr(10), ''))
         + length(text) - length(translate(text, '\#<', '')) AS n FROM src),
placed AS (
  SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) AS upto,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
         count(*) OVER (PARTITION BY conv_id) AS of
  FROM sized)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (role = 'assistant' OR k = of) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""

DIVERGENCE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
t AS (
  SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n, count(DISTINCT rid) AS df
  FROM (SELECT rid, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS lang_n FROM t GROUP BY ALL HAVING sum(df) >= 10),
v AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM k GROUP BY lang),
g AS (
  SELECT lang, source, coalesce(sum(n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT t.* FROM t JOIN k USING (lang, term)) USING (lang, source)
  GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(t.n, 0) AS n,
         1 + (CAST(1000000000 AS HUGEINT) * (coalesce(t.n, 0) + 2)) // (total + 2 * v) AS p,
         1 + (CAST(1000000000 AS HUGEINT) * (lang_n + 2)) // (lang_total + 2 * v) AS q
  FROM g JOIN v ON v.lang = g.lang JOIN k ON k.lang = g.lang
  LEFT JOIN t ON t.lang = g.lang AND t.source = g.source AND t.term = k.term),
s AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
u AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u)
WHERE part = 'pair' OR rank <= 10
"""

NEGATIVES = r"""
WITH e AS (
  SELECT row_number() OVER () AS rid, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
s AS (
  SELECT a.rid AS anchor, a.vec_id AS anchor_id, b.rid, b.vec_id, b.label, a.label = b.label AS same,
         CAST(coalesce(list_sum(list_transform(range(1, least(len(a.q), len(b.q)) + 1), lambda i: a.q[i] * b.q[i])), 0) AS BIGINT)
         AS score
  FROM e a JOIN e b ON a.rid <> b.rid WHERE a.vec_id % 100 = 0),
pos AS (
  SELECT anchor, anchor_id, rid AS positive, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, label, rid) AS k
  FROM s WHERE same),
neg AS (
  SELECT pos.anchor_id, pos.positive_id, s.vec_id AS negative_id, pos.positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY pos.anchor, pos.k ORDER BY s.score DESC, s.vec_id, s.label, s.rid) AS rank
  FROM pos JOIN s ON s.anchor = pos.anchor AND NOT s.same
  WHERE pos.k <= 5 AND 30 * pos.positive_score <= 100 * s.score AND 100 * s.score <= 90 * pos.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM neg WHERE rank <= 10
"""

COLLISIONS = r"""
WITH RECURSIVE e AS (
  SELECT row_number() OVER () AS rid, vec_id, label, CAST(embedding AS DOUBLE[]) AS x,
         coalesce(label IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
                  AND len(list_filter(embedding, lambda v: v <> 0)) > 0, false) AS fits
  FROM embeddings),
links AS (
  SELECT a.rid AS a, b.rid AS b
  FROM e a JOIN e b ON a.label = b.label AND a.rid <> b.rid AND len(a.x) = len(b.x)
  WHERE a.fits AND b.fits AND list_cosine_similarity(a.x, b.x) >= 0.98),
reach AS (SELECT rid AS a, rid AS b FROM e UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT reach.a AS rid, min(e.vec_id) AS component_id FROM reach JOIN e ON e.rid = reach.b GROUP BY reach.a),
many AS (SELECT a AS rid, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id,
       vec_id IS NOT DISTINCT FROM component_id AS kept
FROM e JOIN least USING (rid) LEFT JOIN many USING (rid)
"""
