"""SQL for DuckDB of those queries that SQL can express."""

from __future__ import annotations

URL_FILTER = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parsed AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), ruled AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/en/1%' THEN 'example.org/en/1'
    WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/es/%' THEN 'example.org/es/'
    WHEN ('.' || host) LIKE '%.com' AND path LIKE '/fr/%' THEN 'com/fr/'
    WHEN ('.' || host) LIKE '%.com' AND path LIKE '/de/%' THEN 'com/de/'
    WHEN ('.' || host) LIKE '%.org' THEN 'org/' END AS rule
  FROM parsed
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('example.org/es/', 'example.org/en/1', 'com/de/') THEN 'block'
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
    WHEN regexp_matches(host, '(^|\.)(casino-win|ads-track)(\.|$)') THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""

COLLOCATIONS = r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), pieces AS (
  SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), runs AS (
  SELECT lang, 1 AS words, unnest(w) AS phrase FROM worded
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM worded
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM worded
), counted AS (
  SELECT lang, words, phrase, count(*) AS f FROM runs GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE words = 1 GROUP BY lang
), candidates AS (
  SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE words > 1 AND f >= 10
), cuts AS (
  SELECT lang, words, phrase, a, 1 AS k, w[1] AS lft, array_to_string(w[2:], ' ') AS rgt FROM candidates
  UNION ALL SELECT lang, words, phrase, a, 2, w[1] || ' ' || w[2], w[3] FROM candidates WHERE words = 3
), scores AS (
  SELECT c.lang, c.words, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
         ((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = c.lft JOIN counted y ON y.lang = c.lang AND y.phrase = c.rgt
), worst AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
  SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase, a AS above FROM candidates WHERE words = 3
), covered AS (
  SELECT DISTINCT c.lang, c.phrase FROM candidates c JOIN longer o ON o.lang = c.lang AND o.phrase = c.phrase WHERE 100 * o.above >= 50 * c.a
), ranked AS (
  SELECT w.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
  FROM worst w ANTI JOIN covered USING (lang, phrase)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
RESAMPLING = r"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS crcs
), texts AS (
  SELECT 'raw' AS side, doc_id, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT 'target', NULL, coalesce(text, '') FROM benchmark
), worded AS (
  SELECT side, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), counted AS (
  SELECT word, count(*) FILTER (side = 'raw') AS s, count(*) FILTER (side = 'target') AS t
  FROM (SELECT side, unnest(w) AS word FROM worded) GROUP BY word
), hashed AS (
  SELECT word, s, t, xor(list_reduce(list_transform(range(strlen(word)), lambda i: ('0x' || substr(hex(word), 2 * i + 1, 2))::BIGINT),
    lambda c, b: xor(c >> 8, crcs[xor(c, b) % 256 + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM counted, crc_table
), gains AS (
  SELECT bucket, floor(1000 * ln((sum(t) + 1)::DOUBLE * (sum(sum(s)) OVER () + 10000)::DOUBLE / ((sum(s) + 1)::DOUBLE * (sum(sum(t)) OVER () + 10000)::DOUBLE)))::BIGINT AS gain
  FROM hashed GROUP BY bucket
), of_word AS (
  SELECT word, gain FROM hashed JOIN gains USING (bucket)
), weights AS (
  SELECT doc_id, sum(gain)::BIGINT AS weight FROM (SELECT doc_id, unnest(w) AS word FROM worded WHERE side = 'raw') JOIN of_word USING (word) GROUP BY doc_id
), scored AS (
  SELECT d.doc_id, len(d.w) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM worded d LEFT JOIN weights v ON v.doc_id = d.doc_id WHERE d.side = 'raw'
), placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT s.doc_id, n_features, weight, score, CASE WHEN place <= n * 10 // 100 THEN place END AS rank
FROM scored s LEFT JOIN placed p ON p.doc_id = s.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filter": URL_FILTER, "op11_collocations": COLLOCATIONS, "op12_resampling": RESAMPLING}
