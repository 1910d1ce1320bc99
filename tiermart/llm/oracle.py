"""DuckDB SQL for the corpus queries that SQL can express, stated independently of their Spark code."""

PREFIX_TRIE = """
WITH crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda a, k: xor(a >> 1, 3988292384 * (a & 1))) ORDER BY i) AS t
  FROM range(256) r(i)
), own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS n
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT conv_id,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
             lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295::BIGINT) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM own) CROSS JOIN crc_table
), turns AS (
  SELECT i.conv_id, o.n AS depth, o.role, o.text FROM ids i JOIN own o ON o.conv_id = i.conv_id - i.conv_id % 5 WHERE o.n <= i.h
  UNION ALL
  SELECT i.conv_id, o.n - i.h + least(i.h, coalesce(f.turns, 0)), o.role, o.text
  FROM ids i JOIN own o ON o.conv_id = i.conv_id
  LEFT JOIN (SELECT conv_id, count(*) AS turns FROM own GROUP BY conv_id) f ON f.conv_id = i.conv_id - i.conv_id % 5
  WHERE o.n > i.h
), talks AS (
  SELECT i.conv_id, list(md5(length(t.role) || ':' || t.role || t.text) ORDER BY t.depth) FILTER (t.depth IS NOT NULL) AS marks,
         list(strlen(t.text) ORDER BY t.depth) FILTER (t.depth IS NOT NULL) AS sizes
  FROM ids i LEFT JOIN turns t ON t.conv_id = i.conv_id GROUP BY i.conv_id
), paths AS (
  SELECT conv_id, d AS depth, md5(coalesce(array_to_string(marks[1:d], ''), '')) AS node,
         CASE WHEN d > 0 THEN md5(array_to_string(marks[1:d - 1], '')) END AS parent,
         CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size, d = coalesce(len(marks), 0) AS ends
  FROM talks, unnest(range(coalesce(len(marks), 0) + 1)) u(d)
), nodes AS (
  SELECT depth, node, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved,
         sha256(coalesce(string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM paths GROUP BY depth, node
), families AS (
  SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), below AS (
  SELECT p.depth, p.node, sum(n.saved) AS saved_tokens, count(*) FILTER (f.node IS NULL) AS n_leaves
  FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth
  LEFT JOIN families f ON f.depth = n.depth AND f.node = n.node
  GROUP BY p.depth, p.node
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       coalesce(f.n_children, 0)::BIGINT AS n_children, b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens,
       n.ends_sha256
FROM nodes n JOIN below b ON b.depth = n.depth AND b.node = n.node
LEFT JOIN families f ON f.depth = n.depth AND f.node = n.node
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = n.parent
"""

ORACLE: dict[str, str] = {"op13_prefix_trie": PREFIX_TRIE}
