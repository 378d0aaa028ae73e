"""Mixing sources to target weights by systematic sampling.

Sources, ordered by code point with null last, get weights in a repeating
pattern and share a multiple of all words; no target exceeds `most` times its
source's words, and what is over is shared again among the rest.  Within a
source every document is expected target / source_size times.  Documents are
put in order of size and id, the expected copies are summed along that order,
one offset per source is added, and a document is emitted once for each
integer that its stretch of the running sum passes.  Neighbours have like
sizes, so the words taken stay close to the target.

The order is one range sort of (source, size, id) rows, spread evenly whatever
the largest source is; running sums need only per-partition counts.  Offsets
come from a hash of seed and source, so reruns agree.  Null or empty texts
have size 0 and take no words.  Rows that repeat an id are rows of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, id_bound, word_count

WEIGHTS = (5, 2, 1)
#: At most so many sources are broadcast (about 100 bytes each); beyond, a shuffle join that splits large sources is used.
BROADCAST_SOURCES = 50_000
#: At most so many row keys with their copies are broadcast (20 bytes each).
BROADCAST_ROWS = 500_000


def ranked(df: DataFrame, *order) -> DataFrame:
    """df with `rank`, its row number from 0 in the given order, over all rows and without a one-task sort.

    The sorted rows are written once; within a partition rows are numbered as
    they lie, and the partitions' counts (one row each) give where each begins.
    """
    at = durable(df.orderBy(*order).withColumn("at", F.monotonically_increasing_id()))
    at = at.withColumn("part", F.shiftright("at", 33))
    parts = at.groupBy("part").agg(F.count("*").alias("c")).collect()  # a row for each partition
    begin, starts = 0, {}
    for part, c in sorted(tuple(r) for r in parts):
        starts[part] = begin
        begin += c
    if not starts:
        return at.withColumn("rank", F.col("at")).drop("at", "part")
    # one literal array, indexed by partition number
    table = F.lit([starts.get(p, 0) for p in range(max(starts) + 1)])
    return at.withColumn("rank", F.get(table, F.col("part").cast("int")) + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).drop("at", "part")


def targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, source_size, target, start (rank of the source's first row) from sizes (source, source_size, rows).

    Rounds of one aggregate row each find the level at which the targets that
    are not at their ceiling share what is left by weight.
    """
    s = ranked(sizes, F.col("source").asc_nulls_last())
    s = durable(s.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))))
    level, full = None, -1
    total = s.agg(F.sum("source_size")).first()[0] or 0
    while True:
        at_most = F.lit(False) if level is None else F.lit(level) * F.col("weight") >= most * F.col("source_size")
        n, used, rest = s.agg(
            F.count(F.when(at_most, 1)), F.coalesce(F.sum(F.when(at_most, F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~at_most, F.col("weight"))), F.lit(0)),
        ).first()
        if n == full or not rest:
            break
        full = n
        level = (share * total - most * used) / rest
    level = 0.0 if level is None else level
    return s.select(
        "source", "source_size", "weight",
        F.least(F.lit(level) * F.col("weight"), F.lit(most) * F.col("source_size")).alias("target"),
    )


def row_key(id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> Column:
    """A key of a row's id, text and source."""
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col), F.col(source_col).cast("string"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mix itself: every row of docs as often as it is taken.

    Rows of equal id, text and source are one document, taken as often as all of them.
    """
    taken = mix(docs, id_col, text_col, source_col, **how).groupBy("rk", "doc_id").agg(F.sum("copies").cast("int").alias("copies")).where("copies > 0")
    taken = durable(taken.select(F.col("rk").alias("__taken"), F.col("doc_id").alias("__of"), F.col("copies").alias("__copies")))
    # the key and the id, so that two rows don't meet by chance
    keyed = docs.withColumns({"__rk": row_key(id_col, text_col, source_col), "__id": F.col(id_col).cast("long")})
    one = Window.partitionBy("__rk", "__id").orderBy(*[c for c in docs.columns if c != text_col])
    taken = F.broadcast(taken) if id_bound(taken, BROADCAST_ROWS) else taken
    rows = keyed.join(taken, (F.col("__rk") == F.col("__taken")) & F.col("__id").eqNullSafe(F.col("__of")))
    rows = rows.withColumn("__n", F.row_number().over(one)).where("__n = 1")
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", share: float = 1.5, most: float = 2.0, seed: int = 0) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken of every row of docs, and rk (`row_key`)."""
    rows = durable(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"), row_key(id_col, text_col, source_col).alias("rk"),
    ))
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = durable(targets(sums, share, most))
    order = ranked(rows, F.col("source").asc_nulls_last(), "size", F.col("doc_id").asc_nulls_last(), "rk")
    start = order.groupBy("source").agg(F.min("rank").alias("start"))
    goal = goal.alias("g").join(start.alias("s"), F.col("g.source").eqNullSafe(F.col("s.source"))).select("g.*", "start")
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("source"), F.lit("")))), 1, 5), 16, 10).cast("double") / (1 << 20)
    goal = goal.select(F.col("source").alias("name"), "source_size", "target", "start", offset.alias("offset"))
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    passed = lambda k: F.floor(F.col("offset") + k * each)
    k = F.col("rank") - F.col("start")
    goal = F.broadcast(goal) if id_bound(goal, BROADCAST_SOURCES) else goal
    return (
        order.join(goal, order["source"].eqNullSafe(goal["name"]))
        .withColumn("copies", passed(k + 1) - passed(k))
        .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "rk")
    )
