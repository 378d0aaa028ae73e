"""Line dedup by distinct-site spread: boilerplate lines that many sites share.

Each line hash gets a HyperLogLog sketch of its sites, merged by aggregation
(partly before the shuffle).  Lines whose estimate is clearly over or under the
threshold are settled by it; those near it get an exact distinct count.  A
spread line stays where it first occurs (smallest id, then position) and is
removed everywhere else.  Only DataFrame functions are used.

A line is what lies between newlines, compared without white space at its
ends; lines without a word, or of fewer than `min_words` words where that is
asked for, are never removed.  A null site is
no site.  Null texts stay null, texts without spread lines stay as they are,
a text that loses all its lines becomes empty.  Rows with equal id, site and
text are one document and get the same text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, id_bound, word_count

#: log2 of the sketch's buckets, and its relative standard error.
LG_K = 12
ERROR = 1.04 / 2 ** (LG_K / 2)
BLANK = " \t\r\v\f"
#: At most so many spread lines are broadcast (under 100 bytes each); beyond, a shuffle join that splits frequent lines is used.
BROADCAST_LINES = 300_000


def _key(id_col: str, site_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(site_col), F.col(text_col))


def spread_lines(lines: DataFrame, min_sites: int, sigmas: float = 5.0) -> DataFrame:
    """h1, h2 and first (smallest id, key and position) of the lines on at least min_sites sites."""
    low, high = min_sites * (1 - sigmas * ERROR), min_sites * (1 + sigmas * ERROR)
    spread = durable(
        lines.groupBy("h1", "h2").agg(
            # with a letter before it, as the sketch leaves out empty strings
            F.hll_sketch_agg(F.concat(F.lit("s"), "site"), LG_K).alias("sites"), F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "rk", "pos")).alias("first"),
        )
        .select("h1", "h2", "first", F.hll_sketch_estimate("sites").alias("estimate")).where(F.col("estimate") >= low)
    )
    near = spread.where(F.col("estimate") < high)
    exact = (
        lines.join(near.select("h1", "h2"), ["h1", "h2"], "left_semi").select("h1", "h2", "site").distinct()
        .groupBy("h1", "h2").agg(F.count("site").alias("n")).where(F.col("n") >= min_sites)
    )
    near = near.join(exact.select("h1", "h2"), ["h1", "h2"], "left_semi")
    return spread.where(F.col("estimate") >= high).unionByName(near).select("h1", "h2", "first")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", min_sites: int = 5, min_words: int = 1) -> DataFrame:
    """docs with the cleaned text in text_col, and n_lines and n_removed (these names replace columns of docs)."""
    key = _key(id_col, site_col, text_col)
    lines = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(site_col).cast("string").alias("site"), key.alias("rk"),
        F.posexplode(F.split(F.col(text_col), "\n")).alias("pos", "line"),
    )
    lines = lines.withColumn("line", F.btrim("line", F.lit(BLANK))).where(word_count(F.col("line")) >= min_words)
    # 128 bits of hash, so that two lines don't meet by chance at any size
    lines = durable(lines.select("doc_id", "site", "rk", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")))
    found = durable(spread_lines(lines, min_sites))
    removed = (
        lines.join(F.broadcast(found) if id_bound(found, BROADCAST_LINES) else found, ["h1", "h2"])
        .where(~((F.col("rk") == F.col("first.rk")) & F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("pos") == F.col("first.pos"))))
        .groupBy("rk", "doc_id").agg(F.collect_set("pos").alias("gone"))  # the key and the id, so that two rows don't meet by chance
    )
    out = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    every = F.split(F.col(f"d.{text_col}"), "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col("r.gone"))
    text = F.when(F.col("r.gone").isNull(), F.col(f"d.{text_col}")).otherwise(F.array_join(F.transform(kept, lambda i: F.get(every, i)), "\n"))
    same = (F.col("d.__rk") == F.col("r.rk")) & F.col("d.__id").eqNullSafe(F.col("r.doc_id"))
    joined = docs.select(*out, key.alias("__rk"), F.col(id_col).cast("long").alias("__id")).alias("d").join(removed.alias("r"), same, "left")
    return joined.select(
        *[(text if c == text_col else F.col(f"d.`{c}`")).alias(c) for c in out],
        F.when(F.col(f"d.{text_col}").isNull(), 0).otherwise(F.size(every)).cast("long").alias("n_lines"),
        F.when(F.col("r.gone").isNull(), 0).otherwise(F.size("r.gone")).cast("long").alias("n_removed"),
    )
