"""SQL counterparts of the queries that SQL can express."""

URL_REPUTATION = r"""
WITH urls AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
known AS (
  SELECT doc_id AS page_id, min(CASE WHEN quality = 1 AND coalesce(toxic, 0) = 0 THEN 1 ELSE 0 END) AS good
  FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
hosts AS (
  SELECT host, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain,
         string_split(host, '.')[-1] AS suffix, count(good) AS n, coalesce(sum(good), 0) AS x
  FROM urls LEFT JOIN known USING (page_id) GROUP BY host),
top AS (SELECT (sum(x) + 0.5) / (sum(n) + 1) AS prior FROM hosts),
s0 AS (SELECT suffix, sum(n) AS n, sum(x) AS x, any_value(prior) AS prior FROM hosts, top GROUP BY suffix),
sk AS (
  SELECT 1 / least(greatest(CASE WHEN sum(n * (n - 1) * prior * (1 - prior)) > 0
      THEN (sum((x - n * prior) * (x - n * prior)) - sum(n * prior * (1 - prior)))
           / sum(n * (n - 1) * prior * (1 - prior)) ELSE 0 END, 0.001), 0.9) - 1 AS kappa FROM s0),
s1 AS (SELECT suffix, (x + kappa * prior) / (n + kappa) AS mean FROM s0, sk),
d0 AS (
  SELECT domain, sum(n) AS n, sum(x) AS x, any_value(mean) AS prior
  FROM hosts JOIN s1 USING (suffix) GROUP BY domain),
dk AS (
  SELECT 1 / least(greatest(CASE WHEN sum(n * (n - 1) * prior * (1 - prior)) > 0
      THEN (sum((x - n * prior) * (x - n * prior)) - sum(n * prior * (1 - prior)))
           / sum(n * (n - 1) * prior * (1 - prior)) ELSE 0 END, 0.001), 0.9) - 1 AS kappa FROM d0),
d1 AS (SELECT domain, (x + kappa * prior) / (n + kappa) AS mean FROM d0, dk),
h0 AS (SELECT host, n, x, mean AS prior FROM hosts JOIN d1 USING (domain)),
hk AS (
  SELECT 1 / least(greatest(CASE WHEN sum(n * (n - 1) * prior * (1 - prior)) > 0
      THEN (sum((x - n * prior) * (x - n * prior)) - sum(n * prior * (1 - prior)))
           / sum(n * (n - 1) * prior * (1 - prior)) ELSE 0 END, 0.001), 0.9) - 1 AS kappa FROM h0),
h1 AS (SELECT host, n + kappa AS w, (x + kappa * prior) / (n + kappa) AS m FROM h0, hk),
own AS (
  SELECT host, CASE WHEN m + 1.645 * sqrt(m * (1 - m) / (w + 1)) < 0.5 THEN 'block' ELSE 'allow' END AS own FROM h1),
rules AS (
  SELECT * FROM (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                        ('net', '/es/', 'block'), ('net', '/fr/', 'block')) AS r(rh, rp, rv)),
ruled AS (
  SELECT DISTINCT host, path,
         first(rh || rp ORDER BY length(rh || rp) DESC) OVER w AS rule,
         first(rv ORDER BY length(rh || rp) DESC) OVER w AS verdict
  FROM urls JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
  WINDOW w AS (PARTITION BY host, path))
SELECT u.page_id, u.host, u.path, r.rule, coalesce(r.verdict, o.own) AS verdict
FROM urls u LEFT JOIN ruled r ON u.host = r.host AND u.path = r.path JOIN own o ON u.host = o.host
"""

MIXING = """
WITH size AS (SELECT source, sum(coalesce(strlen(text), 0)) AS n_bytes FROM documents GROUP BY source),
rates AS (
  SELECT source, CASE WHEN n_bytes > 0
      THEN sqrt(n_bytes::DOUBLE) / (SELECT sum(sqrt(n_bytes::DOUBLE)) FROM size)
           * (SELECT sum(n_bytes) FROM size)::DOUBLE / n_bytes ELSE 1.0 END AS rate
  FROM size),
grid AS (
  SELECT source, rate, k, sum(ln(greatest(k, 1)::DOUBLE)) OVER w AS log_fact
  FROM (SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 20)::BIGINT + 1)) AS k FROM rates)
  WINDOW w AS (PARTITION BY source ORDER BY k ROWS UNBOUNDED PRECEDING)),
sums AS (
  SELECT source, k, sum(exp(-rate + k * ln(rate) - log_fact)) OVER (
      PARTITION BY source ORDER BY k ROWS UNBOUNDED PRECEDING) AS cdf FROM grid),
dealt AS (
  SELECT doc_id, source, text, ('0x' || substr(md5('mix-1:' || doc_id), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM documents),
counted AS (
  SELECT d.doc_id, d.source, d.text, (SELECT count(*) FROM sums s WHERE s.source = d.source AND s.cdf <= d.u) AS n
  FROM dealt d),
copies AS (SELECT doc_id, source, text, unnest(range(1, n + 1))::INTEGER AS copy FROM counted)
SELECT doc_id, source, copy,
       ('0x' || substr(md5('mix-1:' || doc_id || ':' || copy), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS order_key,
       text
FROM copies
"""

WARC = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (
  SELECT payload_digest, min(page_id) AS low FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN f.low < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.low < p.page_id THEN f.low END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND p.payload_bytes >= 100
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS INTEGER) AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
u AS (SELECT vec_id, min({'label': label, 'x': x}) AS r FROM v GROUP BY vec_id),
e AS (SELECT vec_id, r.label AS label, r.x AS x FROM u),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(list_sum(list_transform(range(1, least(len(a.x), len(c.x)) + 1), lambda i: a.x[i] * c.x[i])) AS BIGINT) AS score
  FROM e a JOIN e c ON a.vec_id % 50 = 0 AND a.vec_id != c.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

STRUCTURE_REPAIR = r"""
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, b) AS c
    FROM range(256) AS r(b))),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
coded AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(
      list_transform(range(1, length(key) + 1), lambda i: CAST(ord(substr(key, i, 1)) AS BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS code
  FROM keyed, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN code = 1 THEN '' WHEN code = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN code = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM coded WHERE code != 0),
placed AS (
  SELECT *, row_number() OVER own AS i, row_number() OVER same AS nth,
         lag(substr(role, 1, 1)) OVER own AS before,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS tail
  FROM damaged
  WINDOW own AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy),
         same AS (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy)),
judged AS (
  SELECT conv_id, turn, i, role, text, before, substr(role, 1, 1) AS own,
         CASE WHEN tail = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN tail NOT IN ('.', '!', '?') THEN 'truncated'
              ELSE '' END AS fault
  FROM placed),
edits AS (
  SELECT conv_id, i, '' AS r, 3 AS c, 'D' AS e, CAST([] AS VARCHAR[]) AS t FROM judged
  UNION ALL
  SELECT conv_id, i, own, CAST(fault = 'truncated' AS INTEGER), 'K', [role || ':' || text]
  FROM judged WHERE fault NOT IN ('blank', 'duplicate') AND own IN ('s', 'u', 'a')
  UNION ALL
  SELECT conv_id, i, n[1], 2 + CAST(fault = 'truncated' AS INTEGER), 'R', [n || ':' || text]
  FROM judged, (VALUES ('user'), ('assistant')) AS names(n) WHERE fault NOT IN ('blank', 'duplicate')),
moves AS (SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2),
                                (0, '', 0), (1, '', 1), (2, '', 2), (3, '', 3)) AS m(q, r, q2)),
puts AS (SELECT * FROM (VALUES
    (0, 0, 0, '', CAST([] AS VARCHAR[])), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
    (0, 2, 2, 'I', ['user:']), (1, 2, 2, 'I', ['user:']), (3, 2, 2, 'I', ['user:']), (2, 3, 2, 'I', ['assistant:']),
    (0, 3, 4, 'II', ['user:', 'assistant:']), (1, 3, 4, 'II', ['user:', 'assistant:'])) AS p(q, q2, c, e, t)),
best AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, p.q2 AS q, {'c': p.c, 'a': p.e, 't': p.t} AS s
  FROM (SELECT DISTINCT conv_id FROM judged), puts p WHERE p.q = 0
  UNION ALL
  SELECT b.conv_id, e.i, p.q2, min({'c': b.s.c + e.c + p.c, 'a': b.s.a || e.e || p.e, 't': list_concat(b.s.t, e.t, p.t)})
  FROM best b JOIN edits e ON e.conv_id IS NOT DISTINCT FROM b.conv_id AND e.i = b.i + 1
       JOIN moves m ON m.q = b.q AND m.r = e.r JOIN puts p ON p.q = m.q2
  GROUP BY b.conv_id, e.i, p.q2),
told AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, max(i) AS last,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || own NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id),
ended AS (
  SELECT t.conv_id, gaps, blank, duplicate, truncated, illegal, min(s) AS s
  FROM told t JOIN best b ON b.conv_id IS NOT DISTINCT FROM t.conv_id AND b.i = t.last AND b.q IN (0, 3)
  GROUP BY ALL)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(s.c, 0) AS BIGINT) AS cost,
       coalesce(s.a, '') AS audit, sha256(coalesce(array_to_string(s.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""

QUALITY_RULES = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
starts AS (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3),
windows AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x FROM starts),
twice AS (SELECT r, unnest([i, i + 1, i + 2]) AS i FROM (
  SELECT r, i, count(*) OVER (PARTITION BY r, x) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT r, count(DISTINCT i) AS n FROM twice GROUP BY r),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words,
         len(l) AS n_lines,
         length(regexp_replace(t, '\P{L}+', '', 'g')) AS n_letters,
         length(regexp_replace(t, '[^0-9]+', '', 'g')) AS n_digits,
         len(list_filter(l, lambda x: regexp_matches(x, '^ *[-*•]'))) AS n_bullet_lines,
         len(list_filter(l, lambda x: regexp_matches(replace(x, chr(13), ''), '(\.\.\.|…) *$'))) AS n_ellipsis_lines
  FROM w LEFT JOIN repeats USING (r)),
f AS (
  SELECT *, CAST(n_words < 50 AS BIGINT) + 2 * CAST(100 * n_repeat_words > 50 * n_words AS BIGINT)
    + 4 * CAST(word_chars < 2 * n_words AS BIGINT) + 8 * CAST(word_chars > 20 * n_words AS BIGINT)
    + 16 * CAST(100 * n_symbols > 10 * n_words AS BIGINT) + 32 * CAST(100 * n_dup_lines > 50 * n_lines AS BIGINT)
    + 64 * CAST(100 * n_letters < 50 * word_chars AS BIGINT) + 128 * CAST(100 * n_digits > 30 * word_chars AS BIGINT)
    + 256 * CAST(100 * n_bullet_lines > 90 * n_lines AS BIGINT)
    + 512 * CAST(100 * n_ellipsis_lines > 50 * n_lines AS BIGINT) AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failed & 3 != 0 AS base_failed, failed = 0 AS kept, failed FROM f
"""

ORACLE = {
    "op1_url_reputation": URL_REPUTATION,
    "op3_mixing": MIXING,
    "op10_warc": WARC,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op12_structure_repair": STRUCTURE_REPAIR,
    "op13_quality_rules": QUALITY_RULES,
}
