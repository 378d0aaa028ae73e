"""GTFS text writers (O-K1..O-K4): one ordered ``<name>.txt`` with a header for each table.

Tasks write the rows: range-partitioned by the sort key, sorted, as parts
without a header in a staging folder.  The commit joins the parts in range order
behind the header and puts the file in its place in one step, so a reader finds
the old file or the new one, and a rerun begins anew whatever an attempt that
died has left.

A table with a key is checked on the way: equal keys lie next to each other in
the sorted partitions, so the row that repeats one is found without another
shuffle or a second derivation and goes to ``rejected/<name>.txt``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gtfsforge import files
from gtfsforge.operators.first import union_all
from gtfsforge.operators.quality import pk_violations

# GTFS column order of the files written.
GTFS_COLUMNS = {
    "agency": ["agency_id", "agency_name", "agency_url", "agency_timezone", "agency_lang"],
    "feed_info": ["feed_publisher_name", "feed_publisher_url", "feed_lang", "feed_start_date", "feed_end_date",
                  "feed_version"],
    "calendar_dates": ["service_id", "date", "exception_type"],
    "shapes": ["shape_id", "shape_pt_lat", "shape_pt_lon", "shape_pt_sequence"],
    "transfers": ["from_stop_id", "to_stop_id", "from_trip_id", "to_trip_id", "transfer_type", "min_transfer_time"],
}
_FORMAT = {"header": False, "nullValue": "", "emptyValue": "", "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def sorted_for_output(df: DataFrame, keys) -> DataFrame:
    """Globally ordered output across part files: range partitioning + sort inside partitions (O-K3)."""
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def mark_repeats(df: DataFrame, key: list[str]) -> DataFrame:
    """df range-partitioned by its key, with ``__rejected``: whether a part of the key is null, or an earlier row has it (O-K4).

    Which of several rows stays is the first in the order of the other columns.
    The window runs on the range partitions as they are.
    """
    others = [c for c in df.columns if c not in key]
    w = Window.partitionBy(*key).orderBy(*key, *others)
    null = F.exists(F.array(*[F.col(c).isNull() for c in key]), lambda x: x)
    return df.repartitionByRange(*key).withColumn("__rejected", null | (F.row_number().over(w) > 1))


def write_gtfs(df: DataFrame, out_dir: str, name: str, sort: list[str] | None = None, key: list[str] | None = None) -> None:
    """``COPY (...) TO file CSV HEADER``: ``<out_dir>/<name>.txt``, NULL as an empty field (O-K1, O-K3).

    sort: columns of the file's order.  key: columns that identify a row; rows
    that repeat one aren't written, but to ``<out_dir>/rejected/<name>.txt``.
    """
    spark = df.sparkSession
    staging = f"{out_dir.rstrip('/')}/.staging-{name}"
    files.delete(spark, staging)
    order = list(dict.fromkeys([*(sort or []), *(key or [])]))
    rows = mark_repeats(df, key) if key else (df.repartitionByRange(*order) if order else df).withColumn("__rejected", F.lit(False))
    if order and order != (key or order):
        raise ValueError(f"{name} must be sorted by its key")
    if order:
        rows = rows.sortWithinPartitions("__rejected", *order)
    rows.write.mode("overwrite").partitionBy("__rejected").options(**_FORMAT).csv(f"{staging}/rows")
    head = (",".join(df.columns) + "\n").encode()
    for flag, target in (("false", name), ("true", f"rejected/{name}")):
        folder = f"{staging}/rows/__rejected={flag}"
        parts = [f"{folder}/{x}" for x in files.names(spark, folder, "part-")]
        if flag == "false" or key:
            files.join(spark, parts, f"{staging}/{flag}.txt", head)
            files.at(spark, out_dir)[1].mkdirs(files.at(spark, f"{out_dir}/{target}")[0].getParent())
            files.replace(spark, f"{staging}/{flag}.txt", f"{out_dir}/{target}.txt")
    files.delete(spark, staging)


def empty_gtfs(spark: SparkSession, name: str) -> DataFrame:
    """Header-only table (``LIMIT 0``) for feeds without shapes/transfers (O-K2)."""
    schema = StructType([StructField(c, StringType()) for c in GTFS_COLUMNS[name]])
    return spark.createDataFrame([], schema)


def assemble_stop_times(*parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Append the stop_times branches and report (trip_id, stop_sequence) duplicates (O-K4)."""
    out = union_all(*parts)
    return out, pk_violations(out, ["trip_id", "stop_sequence"])
