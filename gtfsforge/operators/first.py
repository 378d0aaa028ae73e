"""Per-group first row, sequences and set helpers (O-W1..O-W5, O-V10, O-O1, O-U1/2).

All are window or aggregate expressions: the group key is the shuffle key, the
order is a sort inside the partition.  No group is collected into one task
beyond what the window itself holds.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """``DISTINCT ON (keys) ... ORDER BY keys, order``: one row per key (O-W1).

    ``order`` must make the pick deterministic (add a tiebreak where the source
    gives none).  Implemented as ``row_number() = 1``; Spark plans this as a
    sort-based window with a group-limit pushed before the shuffle where it can.
    """
    w = Window.partitionBy(*keys).orderBy(*_cols(order))
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def latest(df: DataFrame, keys: Sequence[str], version: str = "version") -> DataFrame:
    """Newest row per key: ``row_number() over (partition by keys order by version desc) = 1`` (O-V10)."""
    return first_per(df, keys, [F.col(version).desc()])


def seq(df: DataFrame, keys: Sequence[str], order: Sequence, out: str, ties: str = "row_number") -> DataFrame:
    """Point / stop sequence number per group (O-W2 row_number, O-W3 rank, O-W4 explicit order)."""
    w = Window.partitionBy(*keys).orderBy(*_cols(order))
    fn = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}[ties]
    return df.withColumn(out, fn().over(w))


def first_last(df: DataFrame, keys: Sequence[str], idx: str, cols: Sequence[str], prefix=("first_", "last_")) -> DataFrame:
    """First and last element per group by ``idx`` (O-W5) with ``min_by``/``max_by``.

    An aggregate, so partial aggregation runs map-side before the shuffle.
    """
    aggs = []
    for c in cols:
        aggs.append(F.min_by(c, idx).alias(prefix[0] + c))
        aggs.append(F.max_by(c, idx).alias(prefix[1] + c))
    return df.groupBy(*keys).agg(*aggs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """SQL ``UNION`` (O-U1)."""
    return reduce(lambda a, b: a.unionByName(b), dfs).distinct()


def union_all(*dfs: DataFrame) -> DataFrame:
    """SQL ``UNION ALL`` / successive inserts (O-U2)."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def not_in(df: DataFrame, other: DataFrame, on: Iterable[str]) -> DataFrame:
    """``(cols) NOT IN (SELECT cols FROM other)`` (O-P4/O-J4).

    SQL NOT IN is null-aware: a NULL on the subquery side empties the result,
    a NULL on the probe side drops the row.  Rows of ``other`` with NULL keys
    are tested for first (a tiny aggregate), the anti-join is a plain
    ``left_anti`` that Catalyst can broadcast or shuffle.
    """
    on = list(on)
    cond = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    probe_ok = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
    out = df.filter(probe_ok).join(other.select(*on).filter(~cond), on, "left_anti")
    # uncorrelated EXISTS: evaluated once, not per row
    return out.filter(~other.filter(cond).exists())


def in_set(df: DataFrame, other: DataFrame, on: Iterable[str]) -> DataFrame:
    """``(cols) IN (SELECT ...)`` / ``EXISTS`` (O-J3) as a left-semi join."""
    on = list(on)
    return df.join(other.select(*on), on, "left_semi")


def ensure_column(df: DataFrame, name: str, dtype: str) -> DataFrame:
    """Add an absent column as NULL (O-P12), e.g. a field a delivery profile lacks."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(dtype))


def case_map(c, mapping: dict, default=None) -> Column:
    """``CASE c WHEN k THEN v ... ELSE default END`` (O-P3)."""
    col = F.col(c) if isinstance(c, str) else c
    out = None
    for k, v in mapping.items():
        out = F.when(col == F.lit(k), F.lit(v)) if out is None else out.when(col == F.lit(k), F.lit(v))
    return out.otherwise(F.lit(default)) if default is not None else out


def key(*cols) -> Column:
    """Composite id ``a||'|'||b||...`` (O-P1); NULL if any part is NULL (``concat``, not ``concat_ws``)."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit("|"))
        parts.append((F.col(c) if isinstance(c, str) else c).cast("string"))
    return F.concat(*parts)
