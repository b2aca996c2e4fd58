"""DuckDB SQL for the queries that SQL can express."""

_LOWER = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz')")
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b
  WHERE 100 * k >= 80 * (x.n + y.n - k)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, root) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT b, root FROM reach JOIN both_ways ON a = doc_id WHERE root < b),
lowest AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM lowest LEFT JOIN n USING (doc_id)
"""

WARC = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
         upper(sha1(coalesce(html, ''))) AS h, coalesce(html, '') AS body FROM pages),
bits AS (
  SELECT *, list_aggregate(list_transform(string_split(h, ''),
    lambda x: substr(bin(16 + strpos('0123456789ABCDEF', x) - 1), 2)), 'string_agg', '') AS b FROM p),
d AS (
  SELECT page_id, payload_bytes, min(page_id) OVER (PARTITION BY body) AS first,
    list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + 16 * substr(b, 5 * i + 1, 1)::INT + 8 * substr(b, 5 * i + 2, 1)::INT
        + 4 * substr(b, 5 * i + 3, 1)::INT + 2 * substr(b, 5 * i + 4, 1)::INT
        + substr(b, 5 * i + 5, 1)::INT, 1)), 'string_agg', '') AS payload_digest
  FROM bits)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""

URL_RULES = r"""
WITH r(host, path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
    ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
p AS (
  SELECT row_number() OVER () AS k, page_id,
    CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (
  SELECT k, page_id, translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path FROM p),
f AS (
  SELECT k, max_by(r.host || r.path, length(r.host || r.path)) AS rule,
         max_by(verdict, length(r.host || r.path)) AS verdict
  FROM u JOIN r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
  GROUP BY k)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN f USING (k)
"""

# crc32 of the decimal id, bit by bit: DuckDB has no such function.
PERIODIC_RUNS = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''),
      lambda x: ascii(x)::BIGINT)), lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda y, z: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END)), 4294967295) AS h
  FROM documents),
a AS (
  SELECT *, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a,
         h // 10 % 8 + 3 AS f FROM d),
t AS (
  SELECT k, doc_id, CASE WHEN a IS NULL THEN w ELSE list_transform(range(len(w)), lambda i:
    CASE WHEN i < a THEN w[i + 1] ELSE w[1 + a + (i - a) % (1 + (len(w) - a) // f)] END) END AS w FROM a),
u AS (SELECT k, len(w) AS n, unnest(w) AS word, unnest(range(len(w))) AS i FROM t),
same AS (
  SELECT x.k, x.i, y.i - x.i AS q FROM u AS x JOIN u AS y
    ON x.k = y.k AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (
  SELECT k, q, i, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS g FROM same),
stretches AS (
  SELECT k, min(i) AS s, count(*) + q AS n, q FROM islands GROUP BY k, q, g
  HAVING count(*) + q >= greatest(6, 4 * q)),
r AS (SELECT k, s, n, min(q) AS q FROM stretches GROUP BY k, s, n),
best AS (
  SELECT k, count(*) AS n_runs, arg_min(r, [-n, s, q]) AS b,
         string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM r GROUP BY k),
dropped AS (SELECT DISTINCT k, unnest(range(s + q, s + n)) AS i FROM r),
kept AS (
  SELECT u.k, string_agg(word, ' ' ORDER BY u.i) AS words FROM u ANTI JOIN dropped USING (k, i) GROUP BY u.k)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS start, b.n AS length, b.q AS period,
       1000 * b.n // b.q AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(coalesce(words, '')) AS collapsed_sha256
FROM t LEFT JOIN best USING (k) LEFT JOIN kept USING (k)
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same,
         list_inner_product(a.x, b.x)::BIGINT AS score
  FROM v AS a JOIN v AS b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT a, b, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5),
n AS (
  SELECT p.a, p.b AS p, p.score AS ps, s.b AS n, s.score AS ns,
         row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS rank
  FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * p.score <= 100 * s.score
    AND 100 * s.score <= 100 * p.score)
SELECT a AS anchor_id, p AS positive_id, rank::INT AS rank, n AS negative_id,
       ps AS positive_score, ns AS negative_score
FROM n WHERE rank <= 5
"""

ORACLE = {"op1_near_duplicates": NEAR_DUPLICATES, "op2_warc_round_trip": WARC,
          "op11_url_rules": URL_RULES,
          "op12_periodic_runs": PERIODIC_RUNS, "op13_hard_negatives": HARD_NEGATIVES}
