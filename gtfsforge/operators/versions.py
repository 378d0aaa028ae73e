"""Version merge, purge and orphan removal for timetable deliveries (O-V1..O-V10).

A delivery is staged as DataFrames with the base schema; merge policies are
anti-joins against the base.  Interval overwrites (O-V3/O-V4) are interval
anti-joins (O-J5), which spread an owner's days over all tasks.

``merge_tables`` merges a whole delivery: OPERDAY decides, and what loses its
last operating day goes from every table below (``keygraph``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gtfsforge.operators.first import latest, union_all
from gtfsforge.operators.intervals import interval_join
from gtfsforge.operators.keygraph import KV1_GRAPH, SCHED_KEY, cascade_all, load_order

UNIT = ["organizationalunitcode", "dataownercode"]


def stamp_version(df: DataFrame, n: int, unitcode=None) -> DataFrame:
    """Stamp the new version number on every staged row (O-V1); unit code optional."""
    out = df.withColumn("version", F.lit(n).cast("int"))
    return out if unitcode is None else out.withColumn("unitcode", F.lit(unitcode))


def unit_code(owner_col: str, key_col: str) -> F.Column:
    """Unit code = owner, except HTM: SGHB when the delivery key mentions 'buzz', else SGHR."""
    return (F.when((F.col(owner_col) == "HTM") & F.lower(F.col(key_col)).contains("buzz"), "SGHB")
            .when(F.col(owner_col) == "HTM", "SGHR").otherwise(F.col(owner_col)))


def clip_before_schedule(operday_d: DataFrame, schedvers: DataFrame) -> DataFrame:
    """Drop staged days before their schedule's validfrom (O-V2); no schedule -> kept."""
    sv = schedvers.select(*SCHED_KEY, F.col("validfrom").alias("__from"))
    return operday_d.join(sv, SCHED_KEY, "left").filter(
        F.col("__from").isNull() | (F.col("validdate") >= F.col("__from"))).drop("__from")


def overwrite_range(base: DataFrame, schedvers_d: DataFrame, unit_match: bool = False) -> DataFrame:
    """Delete base days inside any staged [validfrom, validthru] of the same unit/owner (O-V3, O-V4).

    ``unit_match`` adds the unit code to the key (HTM).
    """
    keys = UNIT + (["unitcode"] if unit_match else [])
    return interval_join(base, schedvers_d, keys, "validdate", "validfrom", "validthru", "anti")


def overwrite_days(base: DataFrame, delta: DataFrame) -> DataFrame:
    """Delete base days present in the delta for the same unit/owner (O-V5)."""
    return base.join(delta.select(*UNIT, "validdate").distinct(), UNIT + ["validdate"], "left_anti")


def overwrite_tail(base: DataFrame, delta: DataFrame) -> DataFrame:
    """Delete base days on or after the first staged day per unit/owner (O-V6);
    units without staged days are untouched."""
    first = delta.groupBy(*UNIT).agg(F.min("validdate").alias("__min"))
    return base.join(first, UNIT, "left").filter(
        F.col("__min").isNull() | (F.col("validdate") < F.col("__min"))).drop("__min")


POLICIES = {
    "range": lambda base, d, sv: overwrite_range(base, sv),
    "range_unit": lambda base, d, sv: overwrite_range(base, sv, unit_match=True),
    "days": lambda base, d, sv: overwrite_days(base, d),
    "tail": lambda base, d, sv: overwrite_tail(base, d),
    "none": lambda base, d, sv: base,
}


def merge(base: DataFrame, delta: DataFrame, schedvers_d: DataFrame | None, policy: str) -> DataFrame:
    """Apply a delete policy to one table, then append the staged rows."""
    kept = POLICIES[policy](base, delta, schedvers_d).select(*base.columns)
    return union_all(kept, delta.select(*base.columns))


def merge_tables(base: dict[str, DataFrame], staged: dict[str, DataFrame], policy: str, graph=KV1_GRAPH) -> dict[str, DataFrame]:
    """A whole delivery merged into a base, tables in load order (O-V6b).

    The policy deletes base days; schedules that had days and have none left
    after the merge are removed, with all rows that refer to them, level by
    level.  Then the staged rows of every table are appended.  A table that only
    one side has is taken from it.
    """
    old = base["operday"]
    days = merge(old, staged["operday"], staged.get("schedvers"), policy) if "operday" in staged else old
    lost = old.select(*SCHED_KEY).distinct().join(days.select(*SCHED_KEY).distinct(), SCHED_KEY, "left_anti")
    kept = cascade_all({k: df for k, df in base.items() if k != "operday"}, graph, {"schedvers": lost}) | {"operday": days}
    out = {}
    for name in load_order(graph, {*base, *staged}):
        parts = [kept[name]] if name in kept else []
        if name in staged and name != "operday":
            parts.append(staged[name].select(*kept[name].columns) if name in kept else staged[name])
        out[name] = union_all(*parts)
    return out


def purge(version: DataFrame, operday: DataFrame, as_of: str) -> tuple[DataFrame, DataFrame]:
    """Set validthru = last operating day per version; versions ending before
    yesterday (or without days) are purged (O-V7).  Returns (kept, purged)."""
    last = operday.groupBy("version", "dataownercode").agg(F.max("validdate").alias("__last"))
    v = version.join(last, ["version", "dataownercode"], "left").withColumn("validthru", F.col("__last")).drop("__last")
    yesterday = F.date_sub(F.lit(as_of).cast("date"), 1)
    gone = F.col("validthru").isNull() | (F.col("validthru") < yesterday)
    return v.filter(~gone), v.filter(gone)


def cascade(child: DataFrame, purged: DataFrame, on=("version", "dataownercode")) -> DataFrame:
    """Remove child rows of purged versions (ON DELETE CASCADE) (O-V7, O-Q4)."""
    return child.join(purged.select(*on), list(on), "left_anti")


def purge_tables(tables: dict[str, DataFrame], as_of: str, graph=KV1_GRAPH) -> tuple[dict[str, DataFrame], DataFrame, bool]:
    """(tables without expired versions, the purged versions, whether there are any) (O-V7)."""
    kept, gone = purge(tables["version"], tables["operday"], as_of)
    below = cascade_all({k: df for k, df in tables.items() if k != "version"}, graph, {}, {"version": gone})
    return {"version": kept, **below}, gone, not gone.isEmpty()


def withdraw(tables: dict[str, DataFrame], version: DataFrame, filenames: DataFrame, graph=KV1_GRAPH) -> dict[str, DataFrame]:
    """Withdraw unpublished deliveries by file name, cascading to every table (O-V8)."""
    gone = version.join(filenames.select("filename"), "filename", "left_semi")
    return cascade_all(tables, graph, {}, {"version": gone})


def drop_orphans(df: DataFrame, operday: DataFrame, keys=SCHED_KEY) -> DataFrame:
    """Remove rows whose schedule key has no operating day (O-V9); NULL-safe key match."""
    od = operday.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return df.join(od, cond, "left_semi")


def latest_rows(df: DataFrame, keys) -> DataFrame:
    """Newest version per key (O-V10)."""
    return latest(df, list(keys))
