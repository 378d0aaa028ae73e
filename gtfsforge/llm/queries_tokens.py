"""Registered queries that tokenise documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_bpe import encode_decode
from .common import table
from .wordpiece import token_counts, vocabulary


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text and their decoded bytes, as digests."""
    import public_tokenizers as vocabularies

    coded = encode_decode(table(spark, sf_dir, "documents"), vocabularies.path("byte_bpe_50k.tiktoken"), vocabularies.PATTERN)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word-piece lengths of every whole text, by the pieces of the sentencepiece vocabulary."""
    import public_tokenizers as vocabularies

    return token_counts(table(spark, sf_dir, "documents"), vocabulary(vocabularies.path("piece_bpe_32k.model")))


QUERIES = {"op3_byte_bpe": op3_byte_bpe, "op6_token_counts": op6_token_counts}
ORACLE: dict[str, str] = {}
