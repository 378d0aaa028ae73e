"""Registered query of the centroid clustering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .laesa import pivot_clusters


def op13_pivot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rounds of 16 centroids over all vectors of 64 components, and the assignment to what they end at."""
    return pivot_clusters(table(spark, sf_dir, "embeddings"))


def _sql(rounds: int = 3) -> str:
    nearest = """
a{i} AS MATERIALIZED (
  SELECT r, c, d FROM (
    SELECT v.r, c.c, CAST(list_sum(list_transform(generate_series(1, 64), lambda i: (v.e[i] - c.e[i]) * (v.e[i] - c.e[i]))) AS BIGINT) AS d
    FROM v CROSS JOIN c{i} c)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)"""
    moved = """
m{i} AS (
  SELECT c, i, CAST(sum(x) AS HUGEINT) AS s, count(*) AS n
  FROM (SELECT a.c, unnest(v.e) AS x, generate_subscripts(v.e, 1) AS i FROM a{i} a JOIN v ON a.r = v.r) GROUP BY c, i),
c{j} AS MATERIALIZED (
  SELECT o.c, coalesce(m.e, o.e) AS e
  FROM c{i} o LEFT JOIN (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS e FROM m{i} GROUP BY c) m ON o.c = m.c)"""
    steps = [nearest.format(i=i) + "," + moved.format(i=i, j=i + 1) for i in range(rounds)] + [nearest.format(i=rounds)]
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), e) - 1 AS c, e FROM v WHERE vec_id IS NOT NULL
  QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id), e) <= 16),{",".join(steps)}
SELECT v.vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v ON a.r = v.r JOIN c{rounds} c ON a.c = c.c
"""


SQL_CLUSTERS = _sql()

QUERIES = {"op13_pivot_clusters": op13_pivot_clusters}
ORACLE = {"op13_pivot_clusters": SQL_CLUSTERS}
