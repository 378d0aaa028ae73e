"""Registered query of the line dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .line_dedup import line_dedup


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that five or more sources share, except where such a line first occurs."""
    return line_dedup(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select("doc_id", "text", "n_lines", "n_removed")


SQL_LINES = r"""
WITH l AS (
  SELECT doc_id, source, generate_subscripts(string_split(text, chr(10)), 1) AS pos, unnest(string_split(text, chr(10))) AS line
  FROM documents),
k AS (
  SELECT doc_id, source, pos, line, trim(line, concat(' ', chr(9), chr(13), chr(11), chr(12))) AS bare FROM l),
b AS (
  SELECT bare, min(struct_pack(doc_id := doc_id, pos := pos)) AS first FROM k
  WHERE bare <> ''
  GROUP BY bare HAVING count(DISTINCT source) >= 5),
m AS (
  SELECT k.doc_id, k.pos, k.line, b.bare IS NOT NULL AND (k.doc_id <> b.first.doc_id OR k.pos <> b.first.pos) AS gone
  FROM k LEFT JOIN b ON k.bare = b.bare),
t AS (
  SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text, count(*) AS n_lines,
         count(*) FILTER (WHERE gone) AS n_removed
  FROM m GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE t.text END AS text, coalesce(t.n_lines, 0) AS n_lines, coalesce(t.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN t ON d.doc_id = t.doc_id
"""

QUERIES = {"op5_line_dedup": op5_line_dedup}
ORACLE = {"op5_line_dedup": SQL_LINES}
