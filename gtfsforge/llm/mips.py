"""Exact top-k inner products over vectors in descending length.

Components are turned into integers floor(scale * x).  Candidates, longest
first, are cut into blocks.  Every query first meets the block of the longest
vectors, which gives a lower bound of its k-th best score.  Queries are then
ordered by the length that a candidate must have to reach that bound, and cut
into blocks anew; a later block is only sent to query blocks for one of whose
queries |q| * (largest length) can still reach the bound.  Inside a block pair
vectors are rotated onto the principal directions of all vectors, so that the
first components carry most of an inner product; a pair is dropped as soon as
the partial sum plus the Cauchy-Schwarz bound of the residuals cannot reach the
query's bound.  What is left is scored in integers.  Bounds keep ties, so the
result is exact.

Vectors that are null or hold a null or non-finite component, don't have the
table's commonest length, or have no id take no part; zero vectors do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable
from .mixing import ranked
from .vectors import classes, common_length, finite, result

#: Candidates and queries of a block.
BLOCK, QUERIES = 4096, 2048
#: Rotated components of the partial sums, one step after the other.
STEPS = (8, 24)
_OUT = pa.schema([("qid", pa.int64()), ("cid", pa.int64()), ("score", pa.int64())])


def integers(t: pa.Table, d: int) -> np.ndarray:
    c = t.column("v").combine_chunks()
    return c.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, d)


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows: in doubles where these hold them exactly."""
    if len(q) and len(c) and float(np.abs(q).max()) * float(np.abs(c).max()) * q.shape[1] < 2**53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    return q @ c.T


def _moments(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for b in batches:
            x = b.column("v").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, d)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["i", "row"])

    return run


def rotation(found: DataFrame, d: int) -> np.ndarray:
    """Right singular vectors of the matrix of all vectors, from its d by d moments."""
    sums = found.select("v").mapInArrow(_moments(d), "i long, row array<double>").select("i", F.posexplode("row").alias("j", "x"))
    total = np.zeros((d, d))
    for i, j, x in sums.groupBy("i", "j").agg(F.sum("x")).collect():  # d * d rows
        total[i, j] = x
    _, _, vt = np.linalg.svd(total / max(1.0, np.abs(total).max()))
    return vt.T


def search_block(q: np.ndarray, c: np.ndarray, bound: np.ndarray, rot: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(candidates, scores) of each query that can be among its best k + 1: at least `bound`, ties by the candidates' order."""
    qr, cr = q @ rot, c @ rot
    rows, cols = None, None
    partial = np.zeros((len(q), len(c)))
    done = 0
    for step in STEPS:
        if step >= q.shape[1]:
            break
        partial += qr[:, done:step] @ cr[:, done:step].T
        done = step
        rest = np.linalg.norm(qr[:, step:], axis=1)[:, None] * np.linalg.norm(cr[:, step:], axis=1)[None, :]
        size = np.abs(partial).max() + rest.max() if partial.size else 0.0
        open_ = partial + rest >= bound[:, None] - 1e-9 * (1 + size)
        if open_.mean() < 0.05:
            rows, cols = np.nonzero(open_)
            break
    if rows is None:
        score = products(q, c)
        rows, cols = np.nonzero(score >= bound[:, None])
        score = score[rows, cols]
    elif float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1] < 2**53:
        score = np.einsum("ij,ij->i", q[rows].astype(float), c[cols].astype(float)).astype(np.int64)
    else:
        score = (q[rows] * c[cols]).sum(1)
    out = []
    at = np.searchsorted(rows, np.arange(len(q) + 1))
    for i in range(len(q)):
        x, s = cols[at[i] : at[i + 1]], score[at[i] : at[i + 1]]
        best = np.lexsort((x, -s))[: k + 1]
        out.append((x[best], s[best]))
    return out


def _pairs(k: int, d: int, rot):
    def run(queries: pa.Table, cands: pa.Table) -> pa.Table:
        if not queries.num_rows or not cands.num_rows:
            return _OUT.empty_table()
        cands = cands.sort_by("low")
        c, cid = integers(cands, d), cands.column("cid").to_numpy()
        out = []
        for at in range(0, queries.num_rows, 256):
            part = queries.slice(at, 256)
            bound = part.column("bound").to_numpy(zero_copy_only=False).astype(float)
            qid = part.column("qid").to_numpy()
            found = search_block(integers(part, d), c, np.where(np.isnan(bound), -np.inf, bound), rot.value, k)
            size = [len(x) for x, _ in found]
            out.append(pa.table([np.repeat(qid, size), cid[np.concatenate([x for x, _ in found])], np.concatenate([s for _, s in found])], schema=_OUT))
        return pa.concat_tables(out)

    return run


def wanted_blocks(ask: DataFrame, ordered: DataFrame, query_block: int = QUERIES) -> tuple[DataFrame, DataFrame | None]:
    """(ask with its block `at`, pairs (at, block) that can still hold a result; None if there is one block of candidates).

    ask: qid, length and bound (null: none) of queries; ordered: block and length
    of candidates.  Queries are ordered by the length from which on a candidate
    can reach their bound, so that no weak query asks for a block of strong ones.
    """
    low = F.coalesce("bound", F.lit(float("-inf")))
    least = F.when(F.col("length") > 0, low / F.col("length")).otherwise(F.when(low <= 0, F.lit(float("-inf"))).otherwise(F.lit(float("inf"))))
    ask = ranked(ask.withColumn("least", least), F.col("least"), "qid").withColumn("at", F.floor(F.col("rank") / query_block)).drop("rank")
    longest = ordered.where("block > 0").groupBy("block").agg(F.max("length").alias("longest"))
    last = longest.agg(F.max("block")).first()[0]
    if last is None:
        return ask, None
    need = ask.groupBy("at").agg(F.min("least").alias("least"))
    pairs = need.withColumn("block", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(last).cast("long")))).join(longest, "block")
    return ask, pairs.where(F.col("longest") * (1 + 1e-9) + 1e-9 >= F.col("least")).select("at", "block")


def top_inner_products(rows: DataFrame, k: int = 20, asked=None, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64, block: int = BLOCK, query_block: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id and score: each query row's k highest integer inner products, ties to the smaller id.

    asked: a condition on rows for the queries (default: every row).
    """
    spark = rows.sparkSession
    v = F.col(vector_col).cast("array<double>")
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"), F.coalesce(asked if asked is not None else F.lit(True), F.lit(False)).alias("asked"))
    rows = rows.where(F.col("vec_id").isNotNull() & finite(F.col("v")))
    d = common_length(rows)
    if d is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows = rows.where(F.size("v") == d).withColumn("v", F.transform("v", lambda x: F.floor(x * scale)))
    found, queries = classes(rows, k)
    rot = spark.sparkContext.broadcast(rotation(found, d))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x.cast("double")))
    ordered = durable(
        ranked(found.select("cid", "v", "low", length.alias("length")), F.desc("length"), "cid").withColumn("block", F.floor(F.col("rank") / block)).drop("rank")
    )
    ask = queries.select("cid").distinct().join(ordered.select("cid", "v", "length"), "cid").withColumnRenamed("cid", "qid")
    ask = durable(ranked(ask, F.xxhash64("qid"), "qid").withColumn("at", F.floor(F.col("rank") / query_block)).drop("rank"))
    pair = lambda q, c: q.groupBy("at", "block").cogroup(c.groupBy("at", "block")).applyInArrow(_pairs(k, d, rot), "qid long, cid long, score long")

    blocks = ask.agg(F.max("at")).first()[0]
    head = ordered.where("block = 0").withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks or 0).cast("long"))))
    first = durable(pair(ask.withColumns({"block": F.lit(0).cast("long"), "bound": F.lit(None).cast("double")}), head.select("at", "block", "cid", F.col("v").alias("v"), "low")))
    kth = (
        first.withColumn("n", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "cid"))).where(F.col("n") == k + 1)
        .select("qid", F.col("score").alias("bound"))
    )
    ask, wanted = wanted_blocks(ask.drop("at").join(kth, "qid", "left").withColumn("bound", F.col("bound").cast("double")), ordered, query_block)
    if wanted is None:
        return result(first, found, queries, k, "long")
    wanted = durable(wanted)
    named = lambda df, *names: df.select(*[F.col(x).alias(x) for x in names])  # noqa: E731  new columns, so that the sides can't be mixed up
    asks = named(ask.join(named(wanted, "at", "block"), "at"), "at", "block", "qid", "v", "bound")
    rest = pair(asks, named(ordered.join(wanted, "block"), "at", "block", "cid", "v", "low"))
    return result(first.unionByName(rest), found, queries, k, "long")
