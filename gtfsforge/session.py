"""Spark session and lineage helpers.

Cluster settings (shuffle partitions, checkpoint dir, ...) come from the
session that the cluster hands us; local defaults are applied only where a
setting is unset, as in tests and the bench.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cpus: int | str = "*", app: str = "gtfsforge") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.legacy.javaCharsets", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    A local session (tests, bench) that names none gets a scratch folder; on a
    cluster a folder of one machine would lose data, so there it is an error.
    """
    cur = spark.conf.get("spark.checkpoint.dir", None)
    if not cur:
        cur = spark.sparkContext.getCheckpointDir() if hasattr(spark.sparkContext, "getCheckpointDir") else None
    if not cur:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        cur = tempfile.mkdtemp(prefix="gtfsforge-ckpt-")
        spark.conf.set("spark.checkpoint.dir", cur)
    spark.sparkContext.setCheckpointDir(cur)
    return cur


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives lost executors)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def register_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Register the driver tables as temp views (lazy; nothing is read here)."""
    for n in names:
        p = os.path.join(sf_dir, f"{n}.parquet")
        if os.path.exists(p):
            spark.read.parquet(p).createOrReplaceTempView(n)
