"""Approximate nearest neighbours by learned partitions.

On a bounded sample the neighbour graph is cut into balanced parts, and a small
classifier (one hidden layer) learns which part a vector belongs to.  Every
vector is indexed in its most probable part.  A query goes to its most probable
parts, as many as the sample's own queries needed to find `recall` of their
neighbours, and is compared there in double precision.  The number of parts
grows with the root of the table up to what the sample can tell apart (128), at
small sizes too; parts are searched in blocks of bounded size, so a large part
is many tasks.

Vectors that are null, zero, hold a null or non-finite component, or don't have
the table's commonest length take no part; nor do rows without an id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, hash_cut, trim
from .vectors import classes, common_length, finite, in_order_products, matrix, result

#: Vectors that the parts and the classifier are fitted on, about.
SAMPLE = 4096
#: Vectors of a block.
BLOCK = 16384
#: Pairs of a query and a candidate that are scored in order at once, about.
PAIRS = 1 << 16
#: Neighbours that the graph joins a sampled vector with, and units of the hidden layer.
DEGREE, HIDDEN = 10, 64
#: Share of the sample's neighbours that the probed parts must hold.
RECALL = 0.97


def neighbour_graph(x: np.ndarray, degree: int) -> np.ndarray:
    """The `degree` nearest others of each row, by inner product."""
    out = []
    for at in range(0, len(x), 128):
        s = x[at : at + 128] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        out.append(np.argpartition(-s, degree - 1, axis=1)[:, :degree])
    return np.concatenate(out)


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, slack: float = 1.1, rounds: int = 12, seed: int = 1) -> np.ndarray:
    """A part for each row, none over slack times the mean size, with few graph edges between parts.

    Seeds grow along the graph; then rows move, the surest first, to the part of
    most of their neighbours where it has room.
    """
    rng = np.random.default_rng(seed)
    n = len(x)
    room = int(np.ceil(slack * n / parts))
    centre = x[rng.choice(n, parts, replace=False)]
    for _ in range(5):
        own = (x @ centre.T).argmax(1)
        sums = np.zeros_like(centre)
        np.add.at(sums, own, x)
        some = np.bincount(own, minlength=parts) > 0
        centre = np.where(some[:, None], sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12), x[rng.choice(n, parts)])
    wish = x @ centre.T
    both = np.concatenate((np.stack((np.repeat(np.arange(n), graph.shape[1]), graph.ravel())), np.stack((graph.ravel(), np.repeat(np.arange(n), graph.shape[1])))), 1)
    part = np.full(n, -1)
    for r in range(rounds):
        if r:
            votes = np.zeros((n, parts))
            np.add.at(votes, (both[0], part[both[1]]), 1.0)
            wish = votes + 1e-3 * (x @ centre.T)
        order = np.argsort(-np.partition(wish, -1, axis=1)[:, -1] if parts > 1 else -wish[:, 0], kind="stable")
        left = np.full(parts, room)
        new = np.empty(n, np.int64)
        ranked = np.argsort(-wish, axis=1, kind="stable")
        for i in order.tolist():
            for p in ranked[i].tolist():
                if left[p]:
                    left[p] -= 1
                    new[i] = p
                    break
        if (new == part).all():
            break
        part = new
    return part


class Router:
    """A small network from a vector to the probabilities of the parts."""

    def __init__(self, x: np.ndarray, part: np.ndarray, parts: int, epochs: int = 30, seed: int = 2):
        rng = np.random.default_rng(seed)
        d = x.shape[1]
        self.scale = 1 / max(1e-12, float(np.sqrt((x**2).mean())))
        w = [rng.normal(0, 1 / np.sqrt(d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, parts)), np.zeros(parts)]
        m, v, t = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
        self.w = w
        for _ in range(epochs):
            for pick in np.array_split(rng.permutation(len(x)), max(1, len(x) // 256)):
                t += 1
                a, y = x[pick] * self.scale, part[pick]
                h = np.maximum(a @ w[0] + w[1], 0)
                z = h @ w[2] + w[3]
                z = np.exp(z - z.max(1, keepdims=True))
                z /= z.sum(1, keepdims=True)
                z[np.arange(len(y)), y] -= 1
                z /= len(y)
                g = (z @ w[2].T) * (h > 0)
                for i, grad in enumerate((a.T @ g, g.sum(0), h.T @ z, z.sum(0))):
                    m[i] = 0.9 * m[i] + 0.1 * grad
                    v[i] = 0.999 * v[i] + 0.001 * grad**2
                    w[i] -= 0.003 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)

    def scores(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum((x * self.scale) @ self.w[0] + self.w[1], 0)
        return h @ self.w[2] + self.w[3]


def fit(x: np.ndarray, parts: int, k: int, recall: float) -> tuple[Router | None, int]:
    """The router, and the number of parts to probe that finds `recall` of held-out rows' k nearest in the sample."""
    if parts < 2:
        return None, 1
    held = np.arange(len(x)) % 8 == 0
    seen, asked = x[~held], x[held][:1024]
    part = balanced_parts(seen, neighbour_graph(seen, min(DEGREE, len(seen) - 1)), parts)
    router = Router(seen, part, parts)
    placed = router.scores(seen).argmax(1)
    near = np.concatenate([np.argpartition(-(asked[at : at + 128] @ seen.T), k - 1, axis=1)[:, :k] for at in range(0, len(asked), 128)])
    order = np.argsort(-router.scores(asked), axis=1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(parts)[None, :], axis=1)
    probes = np.take_along_axis(place, placed[near], axis=1)  # which probe finds each neighbour
    for p in range(1, parts + 1):
        if (probes < p).mean() >= recall:
            break
    return router, p


def _placed(router, d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = router.value
        for b in batches:
            part = r.scores(matrix(b.column("v"), d)).argmax(1) if r and b.num_rows else np.zeros(b.num_rows, np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(part.astype(np.int32))], names=[*b.schema.names, "part"])

    return run


def _routed(router, d: int, probes: int, sizes: dict[int, int], least: int):
    """A row for each probed part: the most probable ones, and further ones until they hold `least` vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = router.value
        for b in batches:
            x = matrix(b.column("v"), d)
            order = np.argsort(-r.scores(x), axis=1, kind="stable") if r and len(x) else np.zeros((len(x), 1), np.int64)
            rows, parts = [], []
            for i, ps in enumerate(order.tolist()):
                held = 0
                for j, p in enumerate(ps):
                    if j >= probes and held >= least:
                        break
                    held += sizes.get(p, 0)
                    if sizes.get(p):
                        rows.append(i)
                        parts.append(p)
            yield pa.RecordBatch.from_arrays([b.column("qid").take(pa.array(rows, pa.int64())), b.column("v").take(pa.array(rows, pa.int64())), pa.array(parts, pa.int32())], names=["qid", "v", "part"])

    return run


def _block_best(k: int, d: int):
    """The k + 1 best candidate classes of each query in one block."""

    def run(queries: pa.Table, cands: pa.Table) -> pa.Table:
        schema = pa.schema([("qid", pa.int64()), ("cid", pa.int64()), ("score", pa.float64())])
        if not queries.num_rows or not cands.num_rows:
            return schema.empty_table()
        cands = cands.sort_by("low")
        c, cid = matrix(cands.column("v"), d), cands.column("cid").to_numpy()
        take = min(len(c), k + 1)
        # two sums of a product differ by at most d * eps of the lengths, so what may be among the best is within twice that
        slack = 2 * d * np.finfo(np.float64).eps * np.sqrt((c**2).sum(1).max())
        out = []
        for at in range(0, queries.num_rows, 512):
            part = queries.slice(at, 512)
            q, qid = matrix(part.column("v"), d), part.column("qid").to_numpy()
            s = q @ c.T
            least = -np.partition(-s, take - 1, axis=1)[:, take - 1] - slack * np.sqrt((q**2).sum(1))
            maybe = ~(s < least[:, None])
            # as many queries at once as keep the products small
            ends = np.cumsum(maybe.sum(1))
            begin = 0
            while begin < len(q):
                to = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + PAIRS, side="right")))
                i, j = np.nonzero(maybe[begin:to])
                exact = in_order_products(q[begin + i], c[j])
                order = np.lexsort((j, -exact, i))  # ties: the smaller id, as candidates are sorted
                i = i[order]
                order = order[np.arange(len(i)) - np.searchsorted(i, i) < take]
                j, exact = j[order], exact[order]
                out.append(pa.table([np.repeat(qid[begin:to], take), cid[j], exact], schema=schema))
                begin = to
        return pa.concat_tables(out)

    return run


def nearest(rows: DataFrame, k: int = 20, asked=None, id_col: str = "vec_id", vector_col: str = "embedding", sample: int = SAMPLE, parts: int | None = None, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id and score of the k candidates of largest inner product found for each query row.

    asked: a condition on rows for the queries (default: every row).  parts: how
    many (default: by the number of vectors); one is searched whole.
    """
    spark = rows.sparkSession
    v = F.col(vector_col).cast("array<double>")
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"), F.coalesce(asked if asked is not None else F.lit(True), F.lit(False)).alias("asked"))
    rows = rows.where(F.col("vec_id").isNotNull() & finite(F.col("v"))).where(F.exists("v", lambda x: x != 0))
    d = common_length(rows)
    if d is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found, queries = classes(rows.where(F.size("v") == d), k)
    n = found.count()
    parts = max(1, min(parts or round(n**0.5 / 4), sample // 32))
    x = np.zeros((0, d))
    if parts > 1:
        taken = found.select("v", F.xxhash64("v").alias("h")).where(F.col("h") <= hash_cut(n, sample)).toArrow()  # about `sample` vectors
        x = matrix(taken.sort_by("h").column("v"), d)
    router, probes = fit(x, parts, k, recall)
    trim()
    router = spark.sparkContext.broadcast(router)
    placed = durable(found.mapInArrow(_placed(router, d), "cid long, v array<double>, ids array<long>, low long, part int"))
    sizes = {r.part: r.c for r in placed.groupBy("part").agg(F.count("*").alias("c")).collect()}  # a row for each part
    ask = queries.select(F.col("cid").alias("qid")).distinct().join(found.select(F.col("cid").alias("qid"), "v"), "qid")
    blocks = F.create_map(*[F.lit(y) for p, c in sizes.items() for y in (int(p), -(-int(c) // BLOCK))])
    cands = placed.withColumn("block", F.pmod(F.xxhash64("cid"), F.element_at(blocks, F.col("part"))).cast("int"))
    routed = ask.mapInArrow(_routed(router, d, probes, sizes, k + 1), "qid long, v array<double>, part int")
    routed = routed.withColumn("block", F.explode(F.sequence(F.lit(0), F.element_at(blocks, F.col("part")) - 1)))
    near = routed.groupBy("part", "block").cogroup(cands.select("part", "block", "cid", "v", "low").groupBy("part", "block")).applyInArrow(
        _block_best(k, d), "qid long, cid long, score double"
    )
    return result(near, found, queries, k, "double")
