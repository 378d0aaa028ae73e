"""Interval join: points against inclusive ranges with equal keys (O-J5).

Joining on the equal keys alone would put all rows of a key into one task (the
keys are an owner and its unit) and compare every point with every range there.
Instead the axis is cut into bins whose width is the mean length of the ranges;
a range goes to the bins that it covers, a point to its own, and the join is
one on (keys, bin) with the range as a residual filter.  A point lies in one
bin, so a pair comes out of one bin only.  Ranges are cut to where points are,
and a range covers MOST_BINS bins at most, so an open end costs no more than
that.  Bins with very many points are split: points get a salt, and the ranges
of such a bin go to each of its salts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType

#: Bins that the points' extent has at most.
MOST_BINS = 4096
#: Points of a bin from which on it is split, and points of a part.
SPLIT_ROWS = 2_000_000


def _axis(c: Column, kind: DataType) -> Column:
    if isinstance(kind, DateType):
        return F.unix_date(c).cast("long")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    return c


def interval_join(left: DataFrame, right: DataFrame, on: list[str], col: str, lo: str, hi: str, how: str = "inner", split_rows: int = SPLIT_ROWS, width: int | None = None) -> DataFrame:
    """Rows of left whose `col` lies in a range [lo, hi] of right with equal `on`.

    how: ``inner`` (left's columns and right's others, a row for each pair),
    ``semi`` or ``anti`` (left's rows).  Null points, ends or keys match
    nothing, reversed ranges are empty.  width: that of a bin (days for dates);
    by default it is measured, which derives right once more.  Right's columns beside `on` must not
    be named as left's for ``inner``.
    """
    if how not in ("inner", "semi", "anti"):
        raise ValueError(f"how must be inner, semi or anti, not {how}")
    point = _axis(F.col(col), left.schema[col].dataType)
    ends = left.agg(F.min(point).alias("a"), F.max(point).alias("z"))
    a, z = ends.select("a").scalar(), ends.select("z").scalar()
    ranges = right if how == "inner" else right.select(*dict.fromkeys([*on, lo, hi]))
    ranges = ranges.withColumns({"__lo": _axis(F.col(lo), right.schema[lo].dataType), "__hi": _axis(F.col(hi), right.schema[hi].dataType)})
    ranges = ranges.where("__lo <= __hi").withColumns({"__a": a, "__z": z})
    cut = ranges.select((F.least("__hi", "__z") - F.greatest("__lo", "__a") + 1).alias("n")).where("n > 0")
    mean = F.lit(float(width)) if width else F.coalesce(cut.agg(F.avg("n").alias("n")).select("n").scalar(), F.lit(1.0))
    width = F.greatest(mean, (F.col("__z") - F.col("__a") + 1) / MOST_BINS, F.lit(1.0))
    ranges = ranges.withColumn("__width", F.ceil(width)).where((F.col("__lo") <= F.col("__z")) & (F.col("__hi") >= F.col("__a")))
    bin_of = lambda c: F.floor((c - F.col("__a")) / F.col("__width"))
    ranges = ranges.withColumn("__bins", F.sequence(bin_of(F.greatest("__lo", "__a")), bin_of(F.least("__hi", "__z"))))
    ranges = ranges.withColumn("__rbin", F.explode("__bins")).drop("__bins", "__a", "__z", "__width").withColumnsRenamed({k: f"__r_{k}" for k in on})

    points = left.withColumns({"__p": point, "__a": a, "__z": z})
    points = points.withColumn("__width", F.ceil(width)).withColumn("__bin", bin_of(F.col("__p"))).drop("__a", "__z", "__width")
    # full bins; there can't be more of them than rows / split_rows
    full = points.where("__bin is not null").groupBy(*on, "__bin").agg(F.ceil(F.count("*") / split_rows).cast("int").alias("__parts")).where("__parts > 1")
    full = F.broadcast(full)
    points = points.join(full, [*on, "__bin"], "left").withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.coalesce("__parts", F.lit(1))).cast("int")).drop("__parts")
    same = reduce(lambda x, y: x & y, [F.col(f"__r_{k}") == F.col(k) for k in on], F.col("__rbin") == F.col("__bin"))
    ranges = ranges.join(full, same, "left").withColumn("__rsalt", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))).drop("__parts", "__bin", *on)
    met = same & (F.col("__rsalt") == F.col("__salt")) & F.col("__p").between(F.col("__lo"), F.col("__hi"))
    out = points.join(ranges, met, {"inner": "inner", "semi": "left_semi", "anti": "left_anti"}[how])
    others = [c for c in right.columns if c not in on] if how == "inner" else []
    return out.select(*left.columns, *others)


def merged_ranges(df: DataFrame, keys: list[str], lo: str, hi: str) -> DataFrame:
    """keys, lo and hi of the days that a key's date ranges cover: overlapping and adjoining ranges become one."""
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy(lo, hi)
    before = F.max(hi).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col(lo) > F.date_add(before, 1), 1).when(before.isNull(), 1).otherwise(0)
    rows = df.where(F.col(lo) <= F.col(hi)).select(*keys, lo, hi).withColumn("__new", new)
    rows = rows.withColumn("__run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return rows.groupBy(*keys, "__run").agg(F.min(lo).alias(lo), F.max(hi).alias(hi)).drop("__run")
