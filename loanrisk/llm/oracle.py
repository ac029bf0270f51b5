"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op1_url_filter"] = r"""
WITH cut AS (
  SELECT page_id,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
rules(verdict, host, path) AS (VALUES
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
found AS (
  SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
    row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC) AS n
  FROM parts p LEFT JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM found WHERE n = 1
"""

ORACLES["op10_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

ORACLES["op3_vector_dedup"] = """
WITH RECURSIVE sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b
    ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95),
reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT r.vec_id, l.b FROM reach r JOIN link l ON l.a = r.other),
least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
counts AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM least LEFT JOIN counts USING (vec_id)
"""

ORACLES["op8_line_dedup"] = r"""
WITH split AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS line,
    unnest(string_split(text, chr(10))) AS whole
  FROM documents WHERE text <> ''),
lines AS (
  SELECT *, regexp_replace(whole, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS bare,
    len(regexp_extract_all(whole, '[^\x20\x09-\x0D]+')) AS words
  FROM split),
placed AS (
  SELECT *, row_number() OVER doc AS place, sum(words) OVER doc AS ends,
    sum(words) OVER (PARTITION BY doc_id) AS total
  FROM lines WHERE words > 0 WINDOW doc AS (PARTITION BY doc_id ORDER BY line)),
runs AS (
  SELECT doc_id, place AS first, place + count(*) OVER w - 1 AS last,
    string_agg(bare, chr(10)) OVER w AS content, total - ends + words >= 50 AS long_enough
  FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY ends - words
    RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
  UNION ALL
  SELECT doc_id, place - count(*) OVER w + 1, place, string_agg(bare, chr(10)) OVER w, ends >= 50
  FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY ends
    RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
ranked AS (
  SELECT *, dense_rank() OVER (PARTITION BY md5(content) ORDER BY doc_id, first) AS n
  FROM runs WHERE long_enough),
gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(first, last)) AS place FROM ranked WHERE n > 1),
marked AS (
  SELECT l.doc_id, l.line, l.whole, g.place IS NOT NULL AS removed
  FROM lines l LEFT JOIN placed p USING (doc_id, line)
  LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.place = p.place),
done AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (removed) AS n_removed,
    string_agg(whole, chr(10) ORDER BY line) FILTER (NOT removed) AS text
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
  coalesce(done.text, '') AS text
FROM documents d LEFT JOIN done USING (doc_id)
"""

ORACLES["op11_lexical_search"] = r"""
WITH cut AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
counts AS (SELECT doc_id, term, count(*) AS tf FROM cut GROUP BY ALL),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM counts GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM sizes),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM counts, whole GROUP BY term, docs),
scores AS (
  SELECT a.item_id, c.doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // words))))::BIGINT AS score
  FROM asked a JOIN counts c USING (term) JOIN weights USING (term) JOIN sizes s ON s.doc_id = c.doc_id, whole
  GROUP BY ALL),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank,
    doc_id, score FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50
"""

ORACLES["op13_importance_resampling"] = r"""
WITH RECURSIVE step(k, byte, state) AS (
  SELECT 0, range, range FROM range(256)
  UNION ALL SELECT k + 1, byte, CASE WHEN state & 1 = 1 THEN xor(state >> 1, 3988292384) ELSE state >> 1 END
  FROM step WHERE k < 8),
crc AS (SELECT list(state ORDER BY byte) AS bytes FROM step WHERE k = 8),
cut AS (
  SELECT 0 AS wanted, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents
  UNION ALL
  SELECT 1, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
hexed AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM cut)),
hashed AS (
  SELECT word, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(0, len(h) // 2),
      lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, bytes[(xor(c, b) & 255) + 1]))) % 10000 AS bucket
  FROM hexed, crc),
held AS (
  SELECT bucket, count(*) FILTER (wanted = 0) AS s, count(*) FILTER (wanted = 1) AS t
  FROM cut JOIN hashed USING (word) GROUP BY bucket),
whole AS (SELECT sum(s)::BIGINT AS all_s, sum(t)::BIGINT AS all_t FROM held),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * (all_s + 10000)) / ((s + 1) * (all_t + 10000))))::BIGINT AS gain
  FROM held, whole),
weights AS (
  SELECT doc_id, count(*) AS n, floor(sum(gain) / count(*))::BIGINT AS weight
  FROM cut JOIN hashed USING (word) JOIN gains USING (bucket) WHERE wanted = 0 GROUP BY doc_id),
scores AS (
  SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5)
      / 4294967296::DOUBLE)))::BIGINT AS score
  FROM documents d LEFT JOIN weights USING (doc_id)),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
    count(*) FILTER (n_features >= 20) OVER () AS able FROM scores)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_features >= 20 AND place <= 10 * able // 100 THEN place END AS rank FROM ordered
"""
