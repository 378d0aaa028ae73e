"""Registered query of the language ID."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .language import identify, learn


def held_out(doc_id: Column) -> Column:
    """Rows that must not teach: crc32 of the id as text leaves 2 modulo 4 (a null id doesn't)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text, learnt from the labels of the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(~held_out(F.col("doc_id"))))
    found = identify(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "proportions")


QUERIES = {"op4_language_id": op4_language_id}
ORACLE: dict[str, str] = {}
