"""The same answers in DuckDB's SQL, for the operators that SQL can express."""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op4_url_cascade"] = r"""
WITH parts AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path
  FROM pages),
rules(verdict, rule_host, rule_path) AS (VALUES
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fits AS (
  SELECT page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    max_by(verdict, length(rule_host || rule_path)) AS verdict
  FROM parts JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits USING (page_id)
"""

SQL["op1_exact_dedup"] = r"""
WITH plain AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text
  FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = min(doc_id) OVER same AS kept, sha256(text) AS text_sha256
FROM plain WINDOW same AS (PARTITION BY text)
"""

SQL["op10_substring_dedup"] = r"""
WITH listed AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
windows AS (
  SELECT doc_id, pos, array_to_string(words[pos:pos + 12], ' ') AS seq
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS pos FROM listed) AS placed),
repeated AS (
  SELECT doc_id, pos FROM (
    SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY seq) AS first_id FROM windows) AS firsts
  WHERE first_id < doc_id),
gone AS (
  SELECT DISTINCT doc_id, pos + k AS pos FROM repeated, (SELECT unnest(range(13)) AS k) AS shifts),
flat AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM listed),
left_over AS (
  SELECT f.doc_id, count(*) FILTER (g.pos IS NOT NULL) AS n_removed,
    string_agg(f.word, ' ' ORDER BY f.pos) FILTER (g.pos IS NULL) AS kept
  FROM flat AS f LEFT JOIN gone AS g ON f.doc_id = g.doc_id AND f.pos = g.pos
  GROUP BY f.doc_id)
SELECT l.doc_id, len(l.words) AS n_words, coalesce(o.n_removed, 0) AS n_removed,
  sha256(coalesce(o.kept, '')) AS kept_sha256
FROM listed AS l LEFT JOIN left_over AS o USING (doc_id)
"""

SQL["op7_jaccard_join"] = r"""
WITH RECURSIVE listed AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[pos:pos + 4], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS pos
    FROM listed WHERE len(words) > 0) AS placed),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM shingles AS x JOIN shingles AS y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b
  WHERE 100 * common >= 80 * (x.n + y.n - common)),
reach(doc_id, seen) AS (
  SELECT doc_id, doc_id FROM sizes
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.seen)
SELECT l.doc_id, coalesce(any_value(z.n), 0) AS n_shingles,
  coalesce(min(r.seen), l.doc_id) AS component_id
FROM listed AS l LEFT JOIN sizes AS z USING (doc_id) LEFT JOIN reach AS r USING (doc_id)
GROUP BY l.doc_id
"""

SQL["op5_source_mix"] = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), 'null') AS id,
    coalesce('s' || source, 'n') AS source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens
  FROM documents),
totals AS (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM docs GROUP BY source),
shares AS (SELECT min(tokens)::DOUBLE / max(tokens) AS least, max(tokens) AS largest
  FROM totals WHERE tokens > 0),
halving(low, high) AS (
  SELECT -1, 1048576
  UNION ALL
  SELECT
    CASE WHEN pow(least, ((low + high) // 2) / 1048576.0) / least <= 2 THEN low
      ELSE (low + high) // 2 END,
    CASE WHEN pow(least, ((low + high) // 2) / 1048576.0) / least <= 2 THEN (low + high) // 2
      ELSE high END
  FROM halving, shares WHERE high - low > 1),
exponent AS (SELECT min(high) / 1048576.0 AS x FROM halving),
wanted AS (
  SELECT source, tokens, CASE WHEN tokens > 0 THEN CAST(round(
    pow(tokens::DOUBLE / largest, CAST(x AS DOUBLE)) * largest) AS BIGINT) ELSE 0 END AS quota
  FROM totals, shares, exponent),
quotas AS (
  SELECT source, CASE WHEN tokens > 0 THEN quota // tokens ELSE 1 END AS passes,
    CASE WHEN tokens > 0 THEN quota % tokens ELSE 0 END AS rest,
    greatest(1, (tokens + 16383) // 16384) AS blocks
  FROM wanted),
placed AS (
  SELECT d.*, passes, rest,
    CAST('0x' || substr(md5('17:' || id), 1, 15) AS BIGINT) % blocks AS block
  FROM docs AS d JOIN quotas USING (source)),
blocks AS (
  SELECT source, block, any_value(rest) AS rest, sum(n_tokens) AS tokens,
    md5('17:' || any_value(passes) || ':' || source || ':' || block) AS block_key
  FROM placed WHERE rest > 0 GROUP BY source, block),
paid AS (
  SELECT source, block, tokens, rest - coalesce(sum(tokens) OVER (PARTITION BY source
    ORDER BY block_key, block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS paid
  FROM blocks),
chosen AS (
  SELECT p.*, paid, tokens, coalesce(sum(n_tokens) OVER (PARTITION BY p.source, p.block
    ORDER BY md5('17:' || passes || ':' || id), id, n_tokens
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
  FROM placed AS p JOIN paid USING (source, block) WHERE rest > 0 AND paid > 0),
passed AS (
  SELECT doc_id, source, n_tokens, block, unnest(range(passes)) AS pass FROM placed
  UNION ALL
  SELECT doc_id, source, n_tokens, block, passes FROM chosen
  WHERE tokens <= paid OR 2 * earlier + n_tokens <= 2 * paid)
SELECT doc_id, CASE WHEN source <> 'n' THEN substr(source, 2) END AS source, n_tokens, pass, block,
  md5('17:' || pass || ':' || source || ':' || block) AS block_key
FROM passed
"""

SQL["op13_hard_negatives"] = r"""
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS row_id, a.label = r.label AS same,
    CAST(list_dot_product(a.x, r.x) AS BIGINT) AS score
  FROM vectors AS a JOIN vectors AS r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id),
positives AS (
  SELECT anchor_id, row_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, row_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER hardest AS INTEGER) AS rank,
  row_id AS negative_id, positive_score, score AS negative_score
FROM positives AS p JOIN scored AS s ON s.anchor_id = p.anchor_id AND NOT same
  AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW hardest AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, row_id)
QUALIFY rank <= 3
"""
