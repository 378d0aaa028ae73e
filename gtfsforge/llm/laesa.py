"""Centroid clustering with a LAESA pivot table.

Components become integers floor(scale * x).  The distances of every vector to
a few fixed pivots are computed once and stored beside it.  In each round the
centroids' distances to the pivots give, by the triangle inequality, a lower
bound |d(v, p) - d(c, p)| of every vector's distance to every centroid; the
centroid of the least bound is measured first, and of the others only those
whose bound doesn't exceed that distance.  Distances that count are exact
integers, bounds are loosened by more than their rounding error, so the result
is that of comparing all.

A round is one pass without a shuffle of vectors: tasks add up the components
by cluster, and k * dims sums meet.  The driver holds the centroids and the
sample that pivots are drawn from, both of fixed size.

Vectors that are null, don't have exactly `dims` components, or hold a null or
non-finite one take no part.  A row without an id is clustered but never a
first centroid; rows that repeat an id are rows of their own (as first
centroids in the order of their components).  With fewer vectors than k there
are fewer centroids; an empty table gives an empty result.  Integer components
beyond the range of a long count as its nearest end, distances and sums of
them beyond it as its largest value.  Other columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, trimmed
from .vectors import finite

#: Pivots, and the vectors (of the smallest id hashes) that they are chosen from.
PIVOTS, SAMPLE = 8, 256
#: Vectors compared at once.
ROWS = 1024
#: Up to this size of components squared distances of at most 2**8 dimensions stay within 64 bits.
SMALL = 1 << 26
LARGEST = (1 << 63) - 1


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows, as 64-bit integers where these hold them, else as Python's."""
    if x.size and (np.abs(x.astype(float)).max() > SMALL or np.abs(c.astype(float)).max() > SMALL or x.shape[-1] > 256):
        x, c = x.astype(object), c.astype(object)
    d = x - c
    return (d * d).sum(-1)


def pivots_of(sample: np.ndarray, n: int) -> np.ndarray:
    """Up to n different vectors of the sample, each as far as can be from those before it; the first is farthest from the mean."""
    x = sample.astype(float)
    if not len(x):
        return sample
    near = ((x - x.mean(0)) ** 2).sum(1)
    chosen = [int(near.argmax())]
    near = ((x - x[chosen[0]]) ** 2).sum(1)
    while len(chosen) < min(n, len(x)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((x - x[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def lengths(x: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Distances of every row of x to every row of others, as doubles."""
    return np.sqrt(np.stack([squared(x, o[None, :]).astype(float) for o in others], 1))


def assign(x: np.ndarray, p: np.ndarray, cents: np.ndarray, cp: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest centroid, its squared distance, distances computed) of each row; p and cp are distances to the pivots."""
    bound = np.zeros((len(x), len(cents)))
    for j in range(p.shape[1]):
        np.maximum(bound, np.abs(p[:, j, None] - cp[None, :, j]), out=bound)
    slack = 1e-9 * (1 + p.max(initial=0) + cp.max(initial=0))
    first = bound.argmin(1)
    best = squared(x, cents[first])
    open_ = np.maximum(bound - slack, 0) ** 2 * (1 - 1e-9) <= best.astype(float)[:, None]
    open_[np.arange(len(x)), first] = False
    rows, cols = np.nonzero(open_)
    found = squared(x[rows], cents[cols])
    wide = best.dtype == object or found.dtype == object
    d = np.full(bound.shape, LARGEST * (1 << 80) if wide else LARGEST, dtype=object if wide else np.int64)
    d[np.arange(len(x)), first] = best
    d[rows, cols] = found
    nearest = d.argmin(1)  # the smaller number of those that tie
    return nearest, d[np.arange(len(x)), nearest], len(x) + len(rows)


def _vectors(b: pa.RecordBatch, dims: int) -> np.ndarray:
    return b.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _parts(b: pa.RecordBatch, dims: int, pivots: int):
    """(row range, vectors, pivot distances) of ROWS rows at a time."""
    for at in range(0, b.num_rows, ROWS):
        part = b.slice(at, ROWS)
        yield part, _vectors(part, dims), part.column("p").flatten().to_numpy(zero_copy_only=False).reshape(-1, pivots)


def _table(pivots: np.ndarray):
    """The pivot table: each vector with its distances to the pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _vectors(b, pivots.shape[1])
            p = np.concatenate([lengths(x[i : i + ROWS], pivots) for i in range(0, len(x), ROWS)]) if len(x) else np.zeros((0, len(pivots)))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("v"), pa.FixedSizeListArray.from_arrays(pa.array(p.ravel()), len(pivots)).cast(pa.list_(pa.float64()))], names=["vec_id", "v", "p"])

    return run


def _sums(cents: np.ndarray, cp: np.ndarray):
    """By cluster and component: the sum and the number of a task's vectors."""
    k, dims = cents.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, dims), object), np.zeros(k, np.int64)
        for b in batches:
            for _, x, p in _parts(b, dims, cp.shape[1]):
                near, _, _ = assign(x, p, cents, cp)
                wide = np.abs(x.astype(float)).max() > SMALL
                part = np.zeros((k, dims), object if wide else np.int64)
                np.add.at(part, near, x.astype(object) if wide else x)
                total += part
                n += np.bincount(near, minlength=k)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(some, dims), pa.int32()), pa.array(np.tile(np.arange(dims), len(some)), pa.int32()),
                pa.array([Decimal(int(s)) for s in total[some].ravel()], pa.decimal128(38, 0)), pa.array(np.repeat(n[some], dims), pa.int64()),
            ],
            names=["cluster", "j", "s", "n"],
        )

    return run


def _assigned(cents: np.ndarray, cp: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, x, p in _parts(b, cents.shape[1], cp.shape[1]):
                near, d, _ = assign(x, p, cents, cp)
                d = np.array([min(int(y), LARGEST) for y in d], np.int64) if d.dtype == object else d
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(near, pa.int32()), pa.array(d, pa.int64())], names=["vec_id", "cluster", "distance"])

    return run


def pivot_clusters(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64, k: int = 16, rounds: int = 3,
    scale: int = 64, seed: str = "1", pivots: int = PIVOTS, sample: int = SAMPLE,
) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256 of every vector that takes part.

    The first centroids are the k vectors of the smallest sha256 of
    `<seed>:<id>`.  Pivots come from `sample` such vectors.
    """
    spark = rows.sparkSession
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    v = F.col(vector_col).cast("array<double>")
    kept = rows.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where((F.size("v") == dims) & finite(F.col("v")))
    kept = kept.withColumn("v", F.transform("v", lambda x: F.floor(x * scale)))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    few = kept.where("vec_id is not null").orderBy(order, "v").limit(max(k, sample)).select("v").collect()  # a fixed number of rows
    if not few:
        return spark.createDataFrame([], schema)
    few = np.array([r.v for r in few], np.int64)
    cents, pivot = few[:k].copy(), pivots_of(few, pivots)
    table = durable(kept.mapInArrow(_table(pivot), "vec_id long, v array<long>, p array<double>"))
    for _ in range(rounds):
        sums = table.mapInArrow(trimmed(_sums(cents, lengths(cents, pivot))), "cluster int, j int, s decimal(38,0), n long")
        for c, j, s, n in sums.groupBy("cluster", "j").agg(F.sum("s"), F.sum("n")).collect():  # k * dims rows
            cents[c, j] = int(s) // n
    out = durable(table.mapInArrow(trimmed(_assigned(cents, lengths(cents, pivot))), "vec_id long, cluster int, distance long"))
    inertia = {c: int(s) for c, s in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}  # k rows
    whole = min(sum(inertia.values()), LARGEST)
    named = [(c, min(s, LARGEST), whole, hashlib.sha256(",".join(map(str, cents[c].tolist())).encode()).hexdigest()) for c, s in inertia.items()]
    named = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
