"""Delivery folder ingest as Structured Streaming (the loader's folder loop, O-S8, O-V3..O-V6b).

A folder of deliveries is a file stream; each micro-batch is one delivery
(``maxFilesPerTrigger``), merged into the stored base table with a merge policy
(``store``), which writes only the partitions that the delivery touches.  A
file that the base holds is left out of a batch, so a replayed epoch, a restart
after a lost commit or a stream with a fresh checkpoint merges no delivery
twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gtfsforge.session import ensure_checkpoint_dir
from gtfsforge.streaming.store import latest_generation, manifest, merge_batch, merged_files, read_base

__all__ = ["latest_generation", "manifest", "merge_batch", "merge_deliveries", "merged_files", "read_base"]


def merge_deliveries(spark: SparkSession, staged_dir: str, base_dir: str, schema, policy: str = "days",
                     checkpoint: str | None = None, files_per_delivery: int = 1, schedvers_dir: str | None = None) -> None:
    """Merge every not-yet-loaded delivery file of ``staged_dir`` into ``base_dir`` and stop.

    ``policy`` is a delete policy of ``operators.versions.merge``.  Range
    policies take the schedule versions of a delivery from the files of the same
    name in ``schedvers_dir``.
    """
    def merge(batch: DataFrame, _) -> None:
        ranges = None
        if schedvers_dir:
            names = [r[0] for r in batch.select(F.element_at(F.split("file", "/"), -1)).distinct().collect()]  # a delivery's files
            ranges = spark.read.parquet(*[f"{schedvers_dir.rstrip('/')}/{n}" for n in names]) if names else None
        merge_batch(spark, batch, base_dir, schema, policy, ranges)

    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/delivery-ingest"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_delivery).parquet(staged_dir)
    named = stream.withColumn("file", F.col("_metadata.file_path"))
    q = named.writeStream.foreachBatch(merge).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()


def merge_planned(spark: SparkSession, plan: DataFrame, staged_dir: str, base_dir: str, schema, baseline_policy: str = "tail", delta_policy: str = "days") -> int:
    """Merge the deliveries of a load plan (``sources.kv1.load_plan``) step by step, whenever their files came; returns how many were merged.

    A step's rows are those of the Parquet file or folder ``<staged_dir>/<zipfile>``.
    The plan has a row for each delivery.
    """
    done = 0
    for r in plan.select("dataownercode", "step", "zipfile", "baseline").orderBy("dataownercode", "step").collect():
        batch = spark.read.schema(schema).parquet(f"{staged_dir.rstrip('/')}/{r.zipfile}").withColumn("file", F.lit(r.zipfile))
        done += merge_batch(spark, batch, base_dir, schema, baseline_policy if r.baseline else delta_policy) > 0
    return done
