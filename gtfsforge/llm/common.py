"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gtfsforge.session import cut_lineage, read_table

#: White space that separates words: the characters 0x20 and 0x09-0x0D.
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def durable(df: DataFrame) -> DataFrame:
    """df written once to the shared checkpoint folder and read from there."""
    return cut_lineage(df)


def let_go(spark: SparkSession) -> None:
    """Delete the shuffle and checkpoint files of what no DataFrame holds any more, not only when the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def word_count(text: Column) -> Column:
    """Words of a whole text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def trim() -> None:
    """Give memory that a Python worker has freed back to the machine; workers live on after a task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def trimmed(run: Callable) -> Callable:
    """A function over Arrow batches that trims the worker's memory when it is through."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        trim()

    return wrapped


def hash_cut(total: int, n: int) -> int:
    """The hash up to which about n of `total` evenly spread 64-bit hashes lie; the largest one if there are no more than n."""
    return (1 << 63) - 1 if total <= n else -(1 << 63) + (1 << 64) * n // total


def hash_sample(rows: DataFrame, column: str, n: int) -> DataFrame:
    """x and its hash h: about n distinct values of a column, those of the smallest hashes (all, if there are no more).

    Only a count goes to the driver, and copies of a value are one before they
    are sent anywhere, so what is taken is as small on any number of tasks.
    """
    hashed = rows.select(F.col(column).alias("x")).withColumn("h", F.xxhash64("x"))
    total = hashed.select("h").distinct().count()
    return hashed.where(F.col("h") <= hash_cut(total, n)).dropDuplicates(["h"])


def id_bound(df: DataFrame, limit: int) -> bool:
    """Whether df has at most `limit` rows; reads no more than limit + 1 of them."""
    return df.limit(limit + 1).count() <= limit
