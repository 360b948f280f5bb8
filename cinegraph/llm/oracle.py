"""DuckDB SQL of the queries that SQL can express."""

MIXING = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce('=' || source, 'null')) || ':'
             || md5(coalesce('=' || text, 'null'))) AS key FROM documents),
numbered AS (SELECT *, row_number() OVER (PARTITION BY key) - 1 AS nth FROM sized),
per_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
sources AS (
  SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
         source_size * 2.0::DOUBLE AS most FROM per_source),
levels(round, level) AS (
  SELECT 0, 0.0::DOUBLE
  UNION ALL
  SELECT round + 1, (SELECT (1.5::DOUBLE * sum(source_size) - sum(CASE WHEN weight * level > most THEN most ELSE 0 END))
                     / nullif(sum(CASE WHEN weight * level > most THEN 0 ELSE weight END), 0) FROM sources)
  FROM levels WHERE round < 100 AND level IS NOT NULL),
targets AS (SELECT *, least(most, weight * (SELECT max(level) FROM levels)) AS target FROM sources),
rated AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
         ('0x' || substr(md5('20:' || d.key || ':' || d.nth::VARCHAR), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
  FROM numbered d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (floor(rate)::BIGINT + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) * size AS taken
FROM rated
"""

PREFIX_TRIE = r"""
WITH RECURSIVE bits(n, k, v) AS (
  SELECT n, 0, n FROM range(256) t(n)
  UNION ALL
  SELECT n, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM bits WHERE k < 8),
crc_table AS (SELECT n, v FROM bits WHERE k = 8),
ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
crc(c, i, v) AS (
  SELECT c, 0, 4294967295 FROM ids
  UNION ALL
  SELECT c, i + 1, xor(r.v // 256, t.v)
  FROM crc r JOIN crc_table t ON t.n = xor(r.v, ascii(substr(c::VARCHAR, i + 1, 1))::BIGINT) % 256
  WHERE i < length(c::VARCHAR)),
kept AS (SELECT c, xor(v, 4294967295) % 9 AS h FROM crc WHERE i = length(c::VARCHAR)),
turns AS (
  SELECT conv_id, key, size, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) AS pos
  FROM (SELECT conv_id, turn, strlen(coalesce(text, ''))::BIGINT AS size,
               md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS key
        FROM conversations WHERE conv_id IS NOT NULL)),
rebuilt AS (
  SELECT k.c, t.pos, t.key, t.size FROM kept k JOIN turns t ON t.conv_id = k.c - k.c % 5 AND t.pos <= k.h
  UNION ALL
  SELECT k.c, 1000000 + t.pos, t.key, t.size FROM kept k JOIN turns t ON t.conv_id = k.c AND t.pos > k.h),
prefixes AS (
  SELECT c, 0 AS depth, '' AS node, 0 AS size FROM ids
  UNION ALL
  SELECT c, row_number() OVER w, string_agg(key, '') OVER w, size FROM rebuilt
  WINDOW w AS (PARTITION BY c ORDER BY pos ROWS UNBOUNDED PRECEDING)),
ends AS (
  SELECT node, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends_sha256
  FROM (SELECT c, max_by(node, depth) AS node FROM prefixes GROUP BY c) GROUP BY node),
nodes AS (SELECT node, depth, min(c) AS conv_id, count(*) AS n_convs, max(size) AS size FROM prefixes GROUP BY node, depth),
edges AS (SELECT left(node, 32 * (depth - 1)) AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
known AS (SELECT n.*, coalesce(e.n_children, 0) AS n_children FROM nodes n LEFT JOIN edges e USING (node)),
below AS (
  SELECT left(node, 32 * a) AS node, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves,
         sum((n_convs - 1) * size)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS a FROM known) GROUP BY 1)
SELECT k.conv_id, k.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, b.n_leaves,
       b.saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM known k JOIN below b USING (node) LEFT JOIN ends e USING (node)
LEFT JOIN nodes p ON k.depth > 0 AND p.node = left(k.node, 32 * (k.depth - 1))
"""

HARD_NEGATIVES = r"""
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
  FROM usable a JOIN usable c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id AND len(a.v) = len(c.v)),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""

ORACLE: dict[str, str] = {"op1_mixing": MIXING, "op11_prefix_trie": PREFIX_TRIE, "op12_hard_negatives": HARD_NEGATIVES}
