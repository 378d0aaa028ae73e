"""Registered query of the HTML extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .html_text import extract_text


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


QUERIES = {"op10_html_text": op10_html_text}
ORACLE: dict[str, str] = {}
