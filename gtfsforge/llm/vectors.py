"""What the two vector searches share: valid vectors, classes of equal ones, and the result rows.

Equal vectors score alike against everything, and of a class only its k + 1
smallest ids can be among any query's k nearest.  So the searches work on
distinct vectors with at most k + 1 ids each; however many rows are copies of
one vector, they are one candidate and one query.  Rows that repeat an id with
another vector are candidates and queries of their own under that id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable


def finite(v: Column) -> Column:
    """Whether an array has components and all are finite numbers."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad, F.lit(True))


def common_length(rows: DataFrame) -> int | None:
    """The commonest length of `v` (ties: the smaller); None if there are no rows."""
    r = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "d").first()
    return r.d if r else None


def classes(rows: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """From rows (vec_id, v): distinct vectors (cid, v, ids, low), and (vec_id, cid) of every row that is asked for.

    rows has `asked`, whether the row is a query.  Rows that repeat an id and a vector are one.
    """
    keyed = rows.withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(1), "v")})
    few = (
        keyed.select("h1", "h2", "vec_id").distinct()
        .withColumn("n", F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id"))).where(F.col("n") <= k + 1)
        .groupBy("h1", "h2").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    one = few.withColumn("low", F.col("ids")[0]).join(keyed.select("h1", "h2", "vec_id", "v"), ["h1", "h2"]).where("vec_id = low").dropDuplicates(["h1", "h2"])
    found = durable(one.select("h1", "h2", "v", "ids", "low", F.monotonically_increasing_id().alias("cid")))
    asked = durable(keyed.where("asked").select("vec_id", "h1", "h2").distinct().join(found.select("h1", "h2", "cid"), ["h1", "h2"]).select("vec_id", "cid"))
    return found.select("cid", "v", "ids", "low"), asked


def matrix(column: pa.ChunkedArray, d: int) -> np.ndarray:
    """A list column as rows of doubles."""
    flat = [c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks] if isinstance(column, pa.ChunkedArray) else [column.flatten().to_numpy(zero_copy_only=False)]
    return np.concatenate(flat).astype(np.float64).reshape(-1, d) if flat else np.zeros((0, d))


def in_order_products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed from the first component to the last in double precision."""
    return np.cumsum(q * c, axis=-1)[..., -1]


def result(near: DataFrame, found: DataFrame, asked: DataFrame, k: int, score_type: str) -> DataFrame:
    """Result rows from near(query class qid, candidate class cid, score): each query's k best rows but itself.

    Per query class its k + 1 best ids are one short array, so a class of very
    many equal queries costs each of them a lookup and no sort.
    """
    best = Window.partitionBy("qid").orderBy(F.desc("score"), F.asc("low"))
    top = (
        near.join(found.select("cid", "ids", "low"), "cid")
        .withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
        .select("qid", "score", F.explode("ids").alias("vec_id"))
    )
    order = Window.partitionBy("qid").orderBy(F.desc("score"), F.asc("vec_id"))
    top = (
        top.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
        .groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("best"))
    )
    rows = asked.withColumnsRenamed({"vec_id": "query_id", "cid": "qid"}).join(top, "qid")
    rows = rows.select("query_id", F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("best"))
    return rows.select("query_id", F.posexplode("best").alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").cast(score_type).alias("score")
    )
