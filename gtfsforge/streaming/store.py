"""A stored base table that a delivery rewrites only where it touches it (O-V3..O-V6b).

Rows lie in partitions by owner and month.  A manifest, one for each generation,
says which folder holds a partition; a merge reads the partitions that its
delete policy or its rows can touch, writes those anew into folders of its own
(copy on write) and names them in the next manifest, beside the old folders of
all others.  A partition that loses its last row stays in the manifest as a
tombstone, without a folder.  A generation counts once its marker is written;
folders that a complete generation names are never written again.

The manifest has a row for each owner and month, and each partition's name goes
through the driver; rows don't.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gtfsforge import files
from gtfsforge.operators import versions

MARKER = "_COMPLETE"
OWNER, DAY = "dataownercode", "validdate"


def latest_generation(spark: SparkSession, base_dir: str) -> int | None:
    """Number of the newest generation of the base table that is complete."""
    found = sorted((int(n[4:]) for n in files.names(spark, base_dir, "gen_")), reverse=True)
    return next((g for g in found if files.exists(spark, f"{folder(base_dir, g)}/{MARKER}")), None)


def folder(base_dir: str, generation: int) -> str:
    return f"{base_dir.rstrip('/')}/gen_{generation:010d}"


def _owner(c: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(c), F.lit("")), "[^A-Za-z0-9]", "-")


def _month(c) -> Column:
    return F.coalesce(F.date_format(c, "yyyyMM"), F.lit("none"))


def manifest(spark: SparkSession, base_dir: str) -> dict[tuple[str, str], str | None]:
    """(owner, month) -> the folder that holds the partition, None if it is a tombstone."""
    g = latest_generation(spark, base_dir)
    if g is None:
        return {}
    return {(r.owner, r.month): r.folder for r in spark.read.parquet(f"{folder(base_dir, g)}/manifest").collect()}


def _read(spark: SparkSession, folders, schema) -> DataFrame:
    folders = sorted(f for f in folders if f)
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_base(spark: SparkSession, base_dir: str, schema) -> DataFrame:
    return _read(spark, manifest(spark, base_dir).values(), schema)


def merged_files(spark: SparkSession, base_dir: str) -> DataFrame:
    """Files (column `file`) whose rows the newest generation holds."""
    g = latest_generation(spark, base_dir)
    return spark.createDataFrame([], "file string") if g is None else spark.read.parquet(f"{folder(base_dir, g)}/files")


def touched(staged: DataFrame, schedvers: DataFrame | None, policy: str, held: set[tuple[str, str]]) -> set[tuple[str, str]]:
    """Partitions that the merge may change: those of staged rows, and of those held the ones whose rows the policy may delete."""
    own = {tuple(r) for r in staged.select(_owner(OWNER), _month(F.col(DAY))).distinct().collect()}
    if policy == "tail":
        first = dict(staged.where(F.col(DAY).isNotNull()).groupBy(_owner(OWNER)).agg(_month(F.min(DAY))).collect())
        own |= {(o, m) for o, m in held if o in first and m >= first[o]}
    elif policy.startswith("range"):
        spans = schedvers.where("validfrom <= validthru").select(_owner(OWNER).alias("owner"), _month(F.col("validfrom")).alias("lo"), _month(F.col("validthru")).alias("hi")).distinct()
        for o, lo, hi in spans.collect():  # pairs of months
            own |= {(p, m) for p, m in held if p == o and lo <= m <= hi}
    return own


def merge_batch(spark: SparkSession, batch: DataFrame, base_dir: str, schema, policy: str, schedvers: DataFrame | None = None) -> int:
    """Merge the rows of batch (with their `file`) that come from files not merged yet, as a new generation.

    schedvers: the staged schedule versions, for range policies.  Returns how
    many partitions were rewritten.
    """
    known = merged_files(spark, base_dir)
    fresh = batch.join(known, "file", "left_anti")
    if fresh.isEmpty():
        return 0
    if policy.startswith("range") and schedvers is None:
        raise ValueError("a range policy needs the staged schedule versions")
    g = latest_generation(spark, base_dir)
    to = folder(base_dir, 0 if g is None else g + 1)
    held = manifest(spark, base_dir)
    files.delete(spark, to)  # an unfinished attempt may be in the way; no reader takes it, as it has no marker
    staged = fresh.drop("file")
    hit = touched(staged, schedvers, policy, set(held))
    merged = versions.merge(_read(spark, [held.get(p) for p in hit], schema), staged, schedvers, policy)
    parts = merged.withColumns({"__owner": _owner(OWNER), "__month": _month(F.col(DAY))}).hint("rebalance", "__owner", "__month")
    parts.write.partitionBy("__owner", "__month").parquet(f"{to}/data")
    now = {}
    for o in files.names(spark, f"{to}/data", "__owner="):
        for m in files.names(spark, f"{to}/data/{o}", "__month="):
            owner = o.split("=", 1)[1].replace("__HIVE_DEFAULT_PARTITION__", "")
            now[owner, m.split("=", 1)[1]] = f"{to}/data/{o}/{m}"
    entries = held | {p: now.get(p) for p in hit} | now
    spark.createDataFrame([(*p, f) for p, f in sorted(entries.items())], "owner string, month string, folder string").coalesce(1).write.parquet(f"{to}/manifest")
    known.unionByName(fresh.select("file").distinct()).write.parquet(f"{to}/files")
    files.touch(spark, f"{to}/{MARKER}")
    return len(hit)
