"""Registered query of the conversation prefix trie."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .prefix_trie import prefix_trie


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct sequence of first turns of the rebuilt conversations, with its members and the totals of its subtree."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


SQL_TRIE = r"""
WITH t AS (
  SELECT conv_id, struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(x ORDER BY pos) AS own FROM t GROUP BY conv_id),
h AS (
  SELECT conv_id, own,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
             lambda crc, s: list_reduce(list_prepend(xor(crc, s), CAST(range(8) AS BIGINT[])),
                 lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, CAST(3988292384 AS BIGINT)) ELSE v // 2 END)), CAST(4294967295 AS BIGINT)) % 4 AS h
  FROM c),
r AS (
  SELECT h.conv_id, list_concat(coalesce(list_slice(b.own, 1, h.h), []), list_slice(h.own, h.h + 1, len(h.own))) AS turns
  FROM h LEFT JOIN c b ON b.conv_id = h.conv_id - h.conv_id % 20),
p AS (SELECT conv_id, len(turns) AS n, turns, unnest(range(len(turns) + 1)) AS depth FROM r),
n AS (
  SELECT depth, list_slice(turns, 1, depth) AS key, min(conv_id) AS conv_id, count(*) AS n_convs, bool_or(n > depth) AS inner_node,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = depth), '') AS ends
  FROM p GROUP BY ALL),
s AS (
  SELECT list_slice(key, 1, up) AS key, sum(leaf) AS n_leaves, sum(gain) AS saved_tokens, count(*) FILTER (WHERE up = depth - 1) AS n_children
  FROM (
    SELECT key, depth, CAST(NOT inner_node AS INTEGER) AS leaf, unnest(range(depth + 1)) AS up,
           (n_convs - 1) * CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(key[depth].text, '[^\x20\x09-\x0D]+')) END AS gain
    FROM n)
  GROUP BY ALL)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, CAST(s.n_children AS BIGINT) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN s ON n.key = s.key LEFT JOIN n u ON u.depth = n.depth - 1 AND u.key = list_slice(n.key, 1, n.depth - 1)
"""

QUERIES = {"op11_prefix_trie": op11_prefix_trie}
ORACLE = {"op11_prefix_trie": SQL_TRIE}
