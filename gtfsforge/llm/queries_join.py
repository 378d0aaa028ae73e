"""Registered query of the n-gram Jaccard join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .ngram_join import ngram_jaccard_join


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingle sets have a Jaccard similarity of 0.85 or more."""
    return ngram_jaccard_join(table(spark, sf_dir, "documents"), width=4, percent=85).select("doc_id", "n_shingles", "component_id")


QUERIES = {"op1_ngram_jaccard_join": op1_ngram_jaccard_join}
ORACLE: dict[str, str] = {}
