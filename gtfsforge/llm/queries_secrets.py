"""Registered query of the secret scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .secrets import scan_secrets


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op7_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole text: counts of the fixed patterns, their digest, and all spans."""
    found = scan_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "crf")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


QUERIES = {"op7_secret_spans": op7_secret_spans}
ORACLE: dict[str, str] = {}
