"""Registered queries that search the embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann import nearest
from .common import table
from .mips import top_inner_products

#: The stated query set: rows whose id is divisible by this.
EVERY = 20


def op2_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every 20th one through learned partitions."""
    return nearest(table(spark, sf_dir, "embeddings"), 20, F.col("vec_id") % EVERY == 0)


def op9_top_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest integer inner products of every 20th vector."""
    return top_inner_products(table(spark, sf_dir, "embeddings"), 20, F.col("vec_id") % EVERY == 0)


SQL_TOP = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(generate_series(1, len(q.e)), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""

QUERIES = {"op2_learned_partitions": op2_learned_partitions, "op9_top_inner_products": op9_top_inner_products}
ORACLE = {"op9_top_inner_products": SQL_TOP}
