"""Registered query of the benchmark decontamination."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .decontaminate import decontaminated


def op12_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that lie inside a window of ten words of a benchmark item."""
    items = F.coalesce("items", F.array().cast("array<string>"))
    return decontaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


_LOW = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SQL_LEAKS = rf"""
WITH b AS (SELECT item_id, coalesce(regexp_extract_all({_LOW}, '{_WORD}'), []) AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
         unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2), lambda i: array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' '))) AS x
  FROM b WHERE len(w) > 0),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all({_LOW}, '{_WORD}'), []) AS w FROM documents),
p AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
l AS (SELECT r, i, list(word) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS l FROM p),
h AS (
  SELECT l.r, l.i, s.n, array_to_string(list_slice(l.l, 1, s.n), ' ') AS x
  FROM l JOIN (SELECT DISTINCT n FROM win) s ON len(l.l) >= s.n
  WHERE array_to_string(list_slice(l.l, 1, s.n), ' ') IN (SELECT x FROM win)),
f AS (SELECT DISTINCT h.r, h.i, h.n, win.item_id FROM h JOIN win ON h.x = win.x AND h.n = win.n),
k AS (SELECT r, count(DISTINCT spot) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS spot FROM f) GROUP BY r),
m AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM f WHERE item_id IS NOT NULL) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(k.n_hit, 0) AS n_hit, coalesce(m.n_items, 0) AS n_items,
       sha256(coalesce(m.ids, '')) AS items_sha256, coalesce(k.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN k ON d.r = k.r LEFT JOIN m ON d.r = m.r
"""

QUERIES = {"op12_benchmark_leaks": op12_benchmark_leaks}
ORACLE = {"op12_benchmark_leaks": SQL_LEAKS}
