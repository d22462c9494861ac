"""The conversation trie and the MinHash near-duplicates stated in DuckDB SQL, for small tables.

The SQL takes other ways on purpose: it groups whole prefixes and adds up every ancestor, and it counts common shingles
of all pairs.
"""

# Fixed value: the reversed polynomial of CRC-32.
_CRC32 = """xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: CAST(ord(s) AS BIGINT))),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [1::BIGINT, 2, 3, 4, 5, 6, 7, 8]),
      lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))))"""

TRIE = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, c - c % 5 AS base, {_CRC32} % 9 AS h FROM (SELECT DISTINCT conv_id AS c FROM turns)
), taken AS (
  SELECT c, 0 AS part, p, r, x FROM convs JOIN turns ON conv_id = base AND p <= h
  UNION ALL SELECT c, 1, p, r, x FROM convs JOIN turns ON conv_id = c AND p > h
), whole AS (
  SELECT c, list({{'r': r, 'x': x}} ORDER BY part, p) AS l FROM taken GROUP BY c
), prefixes AS (
  SELECT c, n, l[1:d] AS k, d FROM (
    SELECT c, coalesce(len(l), 0) AS n, l, unnest(range(0, coalesce(len(l), 0) + 1)) AS d FROM convs LEFT JOIN whole USING (c))
), nodes AS (
  SELECT coalesce(k, []) AS k, d, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CASE WHEN n = d THEN CAST(c AS VARCHAR) END, ',' ORDER BY c), '')) AS ends_sha256
  FROM prefixes GROUP BY 1, 2
), families AS (
  SELECT k[1:d - 1] AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1
), tree AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children, CASE WHEN d > 0 THEN (n_convs - 1) * strlen(nodes.k[d].x) ELSE 0 END AS w
  FROM nodes LEFT JOIN families ON nodes.k = families.k
), sums AS (
  SELECT k[1:a] AS k, sum(w) AS saved, count(*) FILTER (WHERE n_children = 0) AS leaves
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM tree) GROUP BY 1
)
SELECT t.conv_id, t.d AS depth, u.conv_id AS parent_conv_id, t.n_convs, t.n_children, leaves AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, t.ends_sha256
FROM tree t JOIN sums ON t.k = sums.k LEFT JOIN tree u ON u.k = t.k[1:t.d - 1] AND t.d > 0
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^ \\t\\n\\x0B\\f\\r]+') AS w FROM documents
), sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g
  FROM words
), each AS MATERIALIZED (
  SELECT doc_id, n, s FROM (SELECT doc_id, len(g) AS n, hash(unnest(g)) AS s FROM sets) QUALIFY count(*) OVER (PARTITION BY s) > 1
), pairs AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM each a JOIN each b ON a.s = b.s AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), links AS (
  SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sets UNION SELECT doc_id, b FROM reached JOIN links ON other = a
)
SELECT doc_id, any_value(len(g)) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM sets JOIN reached USING (doc_id) GROUP BY doc_id
"""
