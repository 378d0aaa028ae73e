"""Correction rules as data (O-P9, O-P10).

A rule names a condition and either columns with their new values or, without
any, the deletion of the row.  Rules apply in order: a later one sees what an
earlier one changed, and a deleted row meets no more rules.  All rules of a
table become one projection and one filter; nothing is joined or shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    table: str
    name: str
    #: SQL condition over the table's columns; null counts as not met.
    when: str
    #: (column, SQL value) pairs, all values taken before any of them changes; none deletes the row.
    values: tuple[tuple[str, str], ...] = ()


def _applied(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    out = df.withColumn("__gone", F.lit(False))
    for i, r in enumerate(rules):
        met = F.col(f"__met{i}")
        out = out.withColumn(f"__met{i}", F.coalesce(F.expr(r.when), F.lit(False)) & ~F.col("__gone"))
        new = {c: F.when(met, F.expr(v).cast(kinds[c])).otherwise(F.col(c)) for c, v in r.values} or {"__gone": F.col("__gone") | met}
        out = out.withColumns(new)
    return out


def of_table(rules: Sequence[Rule], table: str) -> list[Rule]:
    return [r for r in rules if r.table == table]


def correct(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """df with all rules applied in order."""
    return _applied(df, rules).where("not __gone").select(*df.columns)


def rule_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """rule and rows: how many rows met each rule, in one aggregation."""
    sums = _applied(df, rules).agg(*[F.count(F.when(F.col(f"__met{i}"), 1)).alias(f"n{i}") for i in range(len(rules))])
    pairs = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(f"n{i}").alias("rows")) for i, r in enumerate(rules)])
    return sums.select(F.explode(pairs).alias("x")).select("x.rule", "x.rows")
