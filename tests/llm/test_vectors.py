import math

import numpy as np
import pytest

from gtfsforge.llm.ann import RECALL, balanced_parts, fit, nearest, neighbour_graph
from gtfsforge.llm.mips import top_inner_products, wanted_blocks
from gtfsforge.llm.queries_vectors import SQL_TOP, op2_learned_partitions, op9_top_inner_products
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def odd_rows():
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(size=4).astype(np.float32)], 0) for i in range(120)]
    rows += [(200 + i, [1.0, 0.5, 0.0, -1.0], 1) for i in range(60)]  # equal vectors, queries among them
    rows += [(300, None, 0), (320, [], 0), (340, [1.0, None, 0.0, 0.0], 0), (360, [NAN, 0.0, 0.0, 0.0], 0), (380, [INF, 0.0, 0.0, 0.0], 0), (400, [0.0] * 4, 0), (401, [0.0] * 4, 0), (None, [1.0] * 4, 0)]
    return rows


def best(rows, score, k, keep):
    """Every pair compared."""
    ok = [(i, v) for i, v, *_ in rows if i is not None and v and len(v) == 4 and all(x is not None and math.isfinite(x) for x in v) and keep(v)]
    ok = list({(i, tuple(v)) for i, v in ok})
    out = {}
    for i, v in ok:
        if i % 20 == 0:
            out[i] = sorted(((-score(v, w), j) for j, w in ok if j != i))[:k]
    return {(i, n + 1, j, -s) for i, xs in out.items() for n, (s, j) in enumerate(xs)}


def rows_of(df):
    return {(r.query_id, r.rank, r.vec_id, r.score) for r in df.collect()}


@pytest.mark.parametrize("k", [1, 20])
def test_one_part_is_exact(spark, k):
    df = spark.createDataFrame(odd_rows() + [(7, odd_rows()[7][1], 0)], SCHEMA)
    want = best(odd_rows(), lambda v, w: sum(a * b for a, b in zip(v, w)), k, any)
    got = rows_of(nearest(df, k, F.col("vec_id") % 20 == 0, parts=1))
    assert {x[:3] for x in got} == {x[:3] for x in want}
    assert all(abs(a[3] - b[3]) < 1e-12 for a, b in zip(sorted(got), sorted(want)))


@pytest.mark.parametrize("block,queries", [(4096, 2048), (16, 4)])
def test_top_inner_products_are_exact(spark, block, queries):
    want = best(odd_rows(), lambda v, w: sum(math.floor(64 * a) * math.floor(64 * b) for a, b in zip(v, w)), 20, lambda v: True)
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    assert rows_of(top_inner_products(df, 20, F.col("vec_id") % 20 == 0, block=block, query_block=queries)) == want


def test_lengths_that_prune(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in (rng.normal(size=16) * (1 + (i % 50) ** 2 / 100)).astype(np.float32)], 0) for i in range(1500)]
    x = np.floor(64 * np.array([r[1] for r in rows]))
    got = {}
    for r in top_inner_products(spark.createDataFrame(rows, SCHEMA), 20, F.col("vec_id") % 20 == 0, block=100, query_block=32).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in range(0, 1500, 20):
        s = x @ x[q]
        s[q] = -np.inf
        order = np.lexsort((np.arange(1500), -s))[:20]
        assert sorted(got[q]) == [(n + 1, int(j), int(s[j])) for n, j in enumerate(order)]


def test_strong_queries_ask_for_no_further_block(spark):
    """Eight queries whose bound only the longest candidates reach, between eight weak ones; two without a length."""
    rows = [(q, 2.0, 2.0 * (90 if q % 2 else 3)) for q in range(16)] + [(16, 0.0, 0.0), (17, 1.0, None)]
    ask = spark.createDataFrame(rows, "qid long, length double, bound double")
    ordered = spark.createDataFrame([(b, 100.0 / (b + 1) - i) for b in range(40) for i in range(2)], "block long, length double")
    got, wanted = wanted_blocks(ask, ordered, 10)
    assert {r.qid: r.at for r in got.collect()} == {**{q: int(q % 2) for q in range(16)}, 16: 0, 17: 0}
    assert sorted((r.at, r.block) for r in wanted.collect()) == [(0, b) for b in range(1, 40)]
    got, wanted = wanted_blocks(ask.where("qid < 16"), ordered, 8)
    assert sorted((r.at, r.block) for r in wanted.collect()) == [(0, b) for b in range(1, 33)]  # 100 / 33 reaches 3
    assert wanted_blocks(ask, ordered.where("block = 0"), 8)[1] is None
    assert wanted_blocks(ask.limit(0), ordered, 8)[1].count() == 0


def test_tables(spark, sf, against_sql):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    got, want = against_sql(spark, op9_top_inner_products, SQL_TOP, embeddings=table)
    assert got == want
    assert op2_learned_partitions(spark, sf).count() == 25 * 20


def recall(x, ids, found, k=20):
    hit = n = 0
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        s[q] = -np.inf
        near = set(ids[np.lexsort((ids, -s))[:k]].tolist())
        hit, n = hit + len(near & found[ids[q]]), n + k
    return hit / n


@pytest.mark.parametrize("clusters", [1, 30])
def test_recall_over_several_parts(spark, clusters):
    rng = np.random.default_rng(11)
    x = (rng.normal(size=(3000, 16)) + 4 * rng.normal(size=(clusters, 16))[rng.integers(clusters, size=3000)]).astype(np.float32)
    df = spark.createDataFrame([(i, [float(c) for c in v], 0) for i, v in enumerate(x)], SCHEMA)
    got = nearest(df, 20, F.col("vec_id") % 20 == 0).toPandas().groupby("query_id").vec_id.apply(set)
    assert recall(x.astype(float), np.arange(3000), got) >= 0.9
    assert round(3000**0.5 / 4) > 10  # that many parts


def test_recall_on_the_table(spark, sf):
    t = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    x, ids = np.array(t.embedding.tolist(), dtype=float), t.vec_id.to_numpy()
    got = op2_learned_partitions(spark, sf).toPandas().groupby("query_id").vec_id.apply(set)
    assert len(ids) == 500 and recall(x, ids, got) >= 0.9


def test_probes_hold_the_stated_share_of_held_out_neighbours():
    x = np.random.default_rng(5).normal(size=(2000, 16))
    router, probes = fit(x, 40, 10, RECALL)
    held = np.arange(len(x)) % 8 == 0
    near = np.argsort(-(x[held] @ x[~held].T), axis=1)[:, :10]
    asked = np.argsort(-router.scores(x[held]), axis=1)[:, :probes]
    found = (router.scores(x[~held]).argmax(1)[near][:, :, None] == asked[:, None, :]).any(2)
    assert found.mean() >= 0.97


def test_many_distinct_vectors_that_tie(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in v], 0) for i, v in zip(rng.permutation(1024).tolist(), np.array(np.meshgrid(*[[-1, 1]] * 10)).reshape(10, -1).T)]
    want = {}
    for q, v, _ in rows:
        if q % 20 == 0:
            want[q] = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w, _ in rows if i != q)[:20]
    got = rows_of(nearest(spark.createDataFrame(rows, SCHEMA), 20, F.col("vec_id") % 20 == 0, parts=1))
    assert got == {(q, n + 1, i, -s) for q, xs in want.items() for n, (s, i) in enumerate(xs)}


def test_parts_are_balanced():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1000, 8)) + np.repeat(rng.normal(size=(4, 8)) * 3, (700, 100, 100, 100), axis=0)
    part = balanced_parts(x, neighbour_graph(x, 10), 8)
    assert np.bincount(part, minlength=8).max() <= 138 and len(part) == 1000


@pytest.mark.parametrize("search", [nearest, top_inner_products])
def test_empty_and_too_few(spark, search):
    df = spark.createDataFrame(odd_rows(), SCHEMA + "")
    assert search(df.limit(0), 20).count() == 0
    assert search(spark.createDataFrame([(1, [1.0], 0)], SCHEMA), 20).count() == 0
    two = spark.createDataFrame([(1, [1.0, 2.0], 5, 1), (2, [1.0, 2.0], 5, 2)], SCHEMA + ", cid int")
    assert sorted((r.query_id, r.rank, r.vec_id) for r in search(two, 20).collect()) == [(1, 1, 2), (2, 1, 1)]
