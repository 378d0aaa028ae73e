"""Registered query of the source mix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .mixing import mix


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix of all documents takes."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


#: Copies by whole numbers that offset + rank * share passes; the level by trying every number of full sources.
SQL_MIX = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight
  FROM d GROUP BY source),
r AS (
  SELECT *, 1.5 * CAST(sum(source_size) OVER () AS DOUBLE) AS words,
         row_number() OVER (ORDER BY source_size / weight, source) AS full_up_to,
         coalesce(sum(source_size) OVER (ORDER BY source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
         sum(weight) OVER (ORDER BY source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM s),
levels AS (
  SELECT (words - CAST(2 * below AS DOUBLE)) / weights AS level FROM r
  WHERE (words - CAST(2 * below AS DOUBLE)) / weights * weight < 2.0 * source_size
  ORDER BY full_up_to LIMIT 1),
g AS (
  SELECT source, source_size, least(coalesce((SELECT level FROM levels), 0.0) * weight, 2.0 * source_size) AS target,
         CAST(CAST('0x' || substr(md5('0:' || coalesce(source, '')), 1, 5) AS INTEGER) AS DOUBLE) / 1048576 AS shift
  FROM s),
k AS (
  SELECT d.*, g.source_size, g.target, g.shift, CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0 END AS each,
         row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id NULLS LAST) AS rank
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST((floor(shift + rank * each) - floor(shift + (rank - 1) * each)) * size AS BIGINT) AS taken
FROM k
"""

QUERIES = {"op8_mix_sources": op8_mix_sources}
ORACLE = {"op8_mix_sources": SQL_MIX}
