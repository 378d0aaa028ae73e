"""Relational checks that the reference's DDL enforced at load (O-Q1..O-Q5).

Each check returns the violating rows (an empty result = pass), so a check is
a distributed job like any other and its output can be written next to the feed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pk_violations(df: DataFrame, pk) -> DataFrame:
    """Keys that occur more than once, with their count (O-Q1)."""
    return df.groupBy(*pk).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def fk_violations(child: DataFrame, parent: DataFrame, on, parent_on=None) -> DataFrame:
    """Child rows whose (non-NULL) key has no parent row (O-Q2)."""
    on = list(on)
    parent_on = list(parent_on or on)
    p = parent.select(*[F.col(a).alias(b) for a, b in zip(parent_on, on)]).distinct()
    nn = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
    return child.filter(nn).join(p, on, "left_anti")


def column_violations(df: DataFrame, not_null=(), max_length: dict | None = None, id_cols=()) -> DataFrame:
    """Rows that break NOT NULL or length limits, one row per (row, rule) (O-Q3)."""
    rules = [(f"{c} is null", F.col(c).isNull()) for c in not_null]
    rules += [(f"length({c}) > {n}", F.length(c) > n) for c, n in (max_length or {}).items()]
    arr = F.array(*[F.when(cond, F.lit(name)) for name, cond in rules])
    return df.select(*id_cols, F.explode(F.array_compact(arr)).alias("rule"))


def platform_mismatch(platform: DataFrame, arr: str = "arrival", dep: str = "departure") -> DataFrame:
    """Stops whose arrival and departure platform start with another letter (O-Q5)."""
    return platform.filter(F.col(arr).isNotNull() & F.col(dep).isNotNull()
                           & (F.substring(arr, 1, 1) != F.substring(dep, 1, 1)))
