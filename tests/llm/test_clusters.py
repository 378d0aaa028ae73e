import hashlib
import math

import numpy as np

from gtfsforge.llm.laesa import LARGEST, assign, lengths, pivot_clusters, pivots_of
from gtfsforge.llm.queries_clusters import SQL_CLUSTERS, op13_pivot_clusters

SCHEMA = "vec_id long, embedding array<double>, label int"
NAN, INF = float("nan"), float("inf")


def by_hand(rows, k=16, rounds=3, dims=64):
    """Every distance, with Python's integers."""
    v = [(i, [math.floor(64 * x) for x in e]) for i, e, *_ in rows if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    first = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), x) for i, x in v if i is not None)
    cents = [x for _, x in first[:k]]
    near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(cents))
    for _ in range(rounds):
        at = [near(x)[1] for _, x in v]
        for n in range(len(cents)):
            mine = [x for (_, x), a in zip(v, at) if a == n]
            if mine:
                cents[n] = [sum(c) // len(mine) for c in zip(*mine)]
    at = [near(x) for _, x in v]
    whole = [sum(d for d, a in at if a == n) for n in range(len(cents))]
    cap = lambda x: min(x, LARGEST)
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted((str(i), a, cap(d), cap(sum(cap(d) for d, b in at if b == a)), cap(sum(cap(d) for d, _ in at)), name[a]) for (i, _), (d, a) in zip(v, at)), whole


def got(df):
    return sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


def rows_of(n=300, seed=0):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(size=64) + 3 * (i % 5)], 0) for i in range(n)]


def odd_rows():
    rows = rows_of()
    same = rows[3][1]
    rows += [(500 + i, same, 1) for i in range(80)]  # equal vectors, many in one cluster
    rows += [(7, rows[7][1], 0), (7, rows[8][1], 0), (None, rows[9][1], 0), (None, None, 0)]
    rows += [(600, None, 0), (601, [], 0), (602, [1.0] * 63, 0), (603, [1.0] * 65, 0), (604, [NAN] + [0.0] * 63, 0), (605, [INF] + [0.0] * 63, 0), (606, [None] + [0.0] * 63, 0), (607, [0.0] * 64, 0)]
    return rows


def test_odd_rows_by_hand(spark):
    assert got(pivot_clusters(spark.createDataFrame(odd_rows(), SCHEMA).repartition(5))) == by_hand(odd_rows())[0]


def test_other_parameters(spark):
    rows = [(i, e[:10], 0) for i, e, _ in rows_of(120, 4)]
    df = spark.createDataFrame(rows, SCHEMA)
    for p in (1, 3, 200):
        assert got(pivot_clusters(df, dims=10, k=5, rounds=6, pivots=p)) == by_hand(rows, 5, 6, 10)[0]


def test_against_sql(spark, against_sql, sf):
    odd = spark.createDataFrame(odd_rows(), SCHEMA)
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    for df in (odd, table):
        mine, sql = against_sql(spark, op13_pivot_clusters, SQL_CLUSTERS, embeddings=df)
        assert mine == sql and len(mine) > 16


def test_bounds_spare_distances_and_keep_ties():
    rng = np.random.default_rng(2)
    x = np.floor(64 * (rng.normal(size=(2000, 64)) + 8 * rng.normal(size=(20, 64))[rng.integers(20, size=2000)])).astype(np.int64)
    cents = x[:16]
    pivots = pivots_of(x[:256], 8)
    near, d, n = assign(x, lengths(x, pivots), cents, lengths(cents, pivots))
    every = ((x[:, None, :] - cents[None]) ** 2).sum(-1)
    assert (near == every.argmin(1)).all() and (d == every.min(1)).all()
    assert n < 0.5 * every.size
    tied = np.array([[2] * 64, [0] * 64, [2] * 64])
    assert assign(np.array([[1] * 64, [2] * 64]), np.zeros((2, 0)), tied, np.zeros((3, 0)))[0].tolist() == [0, 0]


def test_very_large_components(spark):
    rows = [(i, [float(10 ** (i % 16)) * (1 + i)] * 64, 0) for i in range(60)]
    assert got(pivot_clusters(spark.createDataFrame(rows, SCHEMA))) == by_hand(rows)[0]


def test_few_and_none(spark):
    df = spark.createDataFrame(rows_of(3), SCHEMA)
    assert got(pivot_clusters(df)) == by_hand(rows_of(3))[0]
    assert pivot_clusters(df.limit(0)).collect() == [] and pivot_clusters(df.limit(0)).columns == pivot_clusters(df).columns
    named = spark.createDataFrame([r + (1, 2, "x") for r in rows_of(20)], SCHEMA + ", cluster int, p int, v string")
    assert got(pivot_clusters(named)) == by_hand(rows_of(20))[0]
