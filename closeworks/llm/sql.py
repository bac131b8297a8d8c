"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op3_url_filters"] = r"""
WITH parts AS (
  SELECT page_id,
         CASE WHEN url LIKE '%://%' THEN translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN url LIKE '%://%' THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
rules(rule_host, rule_path, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (
  SELECT p.page_id, r.rule_host || r.rule_path AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rule_host || r.rule_path) DESC) AS place
  FROM parts p JOIN rules r
    ON (p.host = r.rule_host OR p.host LIKE '%.' || r.rule_host) AND starts_with(p.path, r.rule_path))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON f.page_id = p.page_id AND f.place = 1
"""

SQL["op9_quality_rules"] = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce('=' || source, '') AS host FROM documents),
split AS (
  SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM docs),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n
  FROM (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM split WHERE len(w) >= 3))),
repeats AS (
  SELECT doc_id, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM windows WHERE n >= 2) GROUP BY doc_id),
base AS (
  SELECT s.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(r.n_repeat_words, 0) AS n_repeat_words
  FROM split s LEFT JOIN repeats r ON r.doc_id = s.doc_id),
lines AS (
  SELECT doc_id, host, lower(array_to_string(lw, ' ')) AS line, len(lw) AS words
  FROM (SELECT doc_id, host, list_filter(string_split_regex(l[i], '[\x20\x09-\x0D]+'), lambda x: x <> '') AS lw
        FROM (SELECT doc_id, host, l, unnest(generate_series(1, len(l))) AS i FROM split))),
above AS (SELECT host, line FROM lines GROUP BY host, line HAVING count(DISTINCT doc_id) >= 10),
lost AS (
  SELECT l.doc_id, sum(l.words) AS n FROM lines l JOIN above a ON a.host = l.host AND a.line = l.line GROUP BY l.doc_id)
SELECT b.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - coalesce(x.n, 0) >= n_words * 0.5 AS kept,
       CAST(coalesce(x.n, 0) AS BIGINT) AS n_removed_words
FROM base b LEFT JOIN lost x ON x.doc_id = b.doc_id
"""

SQL["op1_suffix_dedup"] = r"""
WITH bytes AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (SELECT doc_id, h, length(h) // 2 AS n FROM bytes),
windows AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS w
  FROM (SELECT doc_id, h, unnest(generate_series(0, n - 100)) AS i FROM sized WHERE n >= 100)),
again AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS place FROM windows) WHERE place > 1),
runs AS (
  SELECT doc_id, min(i) AS a, max(i) + 100 AS b
  FROM (SELECT doc_id, i, sum(CASE WHEN i - before <= 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run
        FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM again))
  GROUP BY doc_id, run),
gaps AS (
  SELECT r.doc_id, r.a, substr(s.h, 2 * r.z + 1, 2 * (r.a - r.z)) AS part, r.b - r.a AS gone, 1 AS one
  FROM (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z FROM runs) r JOIN sized s ON s.doc_id = r.doc_id
  UNION ALL
  SELECT s.doc_id, s.n, substr(s.h, 2 * coalesce(x.b, 0) + 1), 0, 0
  FROM sized s LEFT JOIN (SELECT doc_id, max(b) AS b FROM runs GROUP BY doc_id) x ON x.doc_id = s.doc_id)
SELECT s.doc_id, CAST(any_value(s.n) AS BIGINT) AS n_bytes, CAST(sum(gone) AS BIGINT) AS n_removed,
       CAST(sum(one) AS BIGINT) AS n_spans, sha256(unhex(string_agg(part, '' ORDER BY a))) AS kept_sha256
FROM sized s JOIN gaps g ON g.doc_id = s.doc_id GROUP BY s.doc_id
"""

SQL["op8_substring_dedup"] = r"""
WITH split AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM split WHERE len(w) >= 20)),
again AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS place FROM windows) WHERE place > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS k FROM again),
words AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS k FROM split),
kept AS (
  SELECT x.doc_id, count(*) AS n, string_agg(x.word, ' ' ORDER BY x.k) AS text
  FROM words x LEFT JOIN gone g ON g.doc_id = x.doc_id AND g.k = x.k WHERE g.k IS NULL GROUP BY x.doc_id)
SELECT s.doc_id, CAST(len(s.w) AS BIGINT) AS n_words, CAST(len(s.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM split s LEFT JOIN kept k ON k.doc_id = s.doc_id
"""

SQL["op10_jaccard_join"] = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM split WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
links AS (
  SELECT s.a, s.b FROM shared s JOIN sizes p ON p.doc_id = s.a JOIN sizes q ON q.doc_id = s.b
  WHERE 100 * s.n >= 75 * (p.n + q.n - s.n)),
reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(z.n, 0) AS BIGINT) AS n_shingles, CAST(least(d.doc_id, coalesce(r.b, d.doc_id)) AS BIGINT) AS component_id
FROM documents d LEFT JOIN sizes z ON z.doc_id = d.doc_id LEFT JOIN least_of r ON r.a = d.doc_id
"""

# DuckDB has no crc32: its table follows from the polynomial, and a word's bytes are folded over it.
SQL["op12_importance_sampling"] = r"""
WITH RECURSIVE steps(i, k, c) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
both_tables AS (
  SELECT true AS doc, doc_id AS id, text FROM documents UNION ALL SELECT false, item_id, text FROM benchmark),
words AS (
  SELECT doc, id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM both_tables),
hashed AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, length(h) // 2),
                lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
                lambda c, b: xor(t[CAST(xor(c, b) % 256 AS BIGINT) + 1], c >> 8)), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT w, hex(encode(w)) AS h FROM words), crc),
counts AS (
  SELECT b AS bucket, count(*) FILTER (WHERE doc) AS s, count(*) FILTER (WHERE NOT doc) AS t
  FROM range(10000) r(b) LEFT JOIN (SELECT doc, bucket FROM words JOIN hashed USING (w)) x ON x.bucket = b GROUP BY b),
totals AS (SELECT CAST(sum(s) AS DOUBLE) + 10000 AS all_s, CAST(sum(t) AS DOUBLE) + 10000 AS all_t FROM counts),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * all_s / ((CAST(s AS DOUBLE) + 1) * all_t))) AS BIGINT) AS gain
  FROM counts, totals),
weights AS (
  SELECT id, count(*) AS n, sum(gain) AS weight FROM words JOIN hashed USING (w) JOIN gains USING (bucket) WHERE doc GROUP BY id),
scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
         / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM documents LEFT JOIN weights ON id = doc_id),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS able FROM scored WHERE n_features >= 20)
SELECT s.doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
       CASE WHEN place <= 10 * able // 100 THEN place END AS rank
FROM scored s LEFT JOIN ranked r ON r.doc_id = s.doc_id
"""

# One round after the other, every part against every entry. Whole numbers below 2^53 are exact as doubles.
_ROUND = r"""
near{n} AS MATERIALIZED (
  SELECT vec_id, p, arg_min(e, (d, e)) AS e, min(d) AS d
  FROM (SELECT x.vec_id, x.p, b.e, list_dot_product(x.v, x.v) - 2 * list_dot_product(x.v, b.v) + list_dot_product(b.v, b.v) AS d
        FROM parts x JOIN book{n} b ON b.p = x.p) GROUP BY vec_id, p)"""
_BOOK = r"""
means{n} AS (
  SELECT p, e, list(m ORDER BY i) AS v
  FROM (SELECT p, e, i, floor(sum(c) / count(*)) AS m
        FROM (SELECT x.p, a.e, unnest(x.v) AS c, unnest(range(len(x.v))) AS i FROM parts x JOIN near{n} a ON a.vec_id = x.vec_id AND a.p = x.p)
        GROUP BY p, e, i) GROUP BY p, e),
book{m} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book{n} b LEFT JOIN means{n} m ON m.p = b.p AND m.e = b.e)"""

SQL["op13_vector_codes"] = (
    r"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, p, v[p * len(v) // 4 + 1 : (p + 1) * len(v) // 4] AS v FROM kept, range(4) r(p)),
book0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v FROM parts
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 256)),"""
    + ",".join(f"{_ROUND.format(n=n)},{_BOOK.format(n=n, m=n + 1)}" for n in range(4))
    + ","
    + _ROUND.format(n=4)
    + r""",
coded AS (
  SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near4 GROUP BY vec_id),
digest AS (
  SELECT sha256(string_agg(array_to_string(list_transform(v, lambda x: CAST(x AS BIGINT)), ','), ',' ORDER BY p, e)) AS h FROM book4)
SELECT c.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM coded c JOIN kept k ON k.vec_id = c.vec_id, digest
"""
)
