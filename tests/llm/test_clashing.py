"""Every query over documents with columns named as its own, and a very long text of one line: the same rows as without."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from gtfsforge.llm import registry

EXTRA = ["n_words", "score", "lang_pred", "proportions", "token", "rk", "h1", "sa", "pos", "size", "taken", "rank", "n_lines", "n_removed", "gone", "__rk", "__id", "__text", "__n", "ids", "decoded", "spans"]
OPS = ["op1", "op3", "op4", "op5", "op6", "op7", "op8", "op12"]


@pytest.fixture(scope="module")
def tables(spark, sf, tmp_path_factory):
    at = [str(tmp_path_factory.mktemp(x)) for x in ("plain", "clashing")]
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    long = spark.createDataFrame([(10**6, "long line of words " * 15_000, "en", "s1", 285_000)], docs.schema)
    docs = docs.unionByName(long)
    docs.write.parquet(f"{at[0]}/documents.parquet")
    spark.read.parquet(f"{at[0]}/documents.parquet").withColumns({c: F.lit("x") for c in EXTRA}).write.parquet(f"{at[1]}/documents.parquet")
    for a in at:
        spark.read.parquet(f"{sf}/benchmark.parquet").withColumn("window", F.lit(1)).write.parquet(f"{a}/benchmark.parquet")
    return at


@pytest.mark.parametrize("op", OPS)
def test_query(spark, tables, op):
    query, = [f for name, f in registry.QUERIES.items() if name.startswith(op + "_")]
    plain, clashing = (sorted(map(repr, query(spark, t).collect())) for t in tables)
    assert plain == clashing and len(plain) == 61


def test_pipeline_stages_keep_other_columns(spark, tables):
    docs = [spark.read.parquet(f"{t}/documents.parquet") for t in tables]
    for _, stage in cp.STAGES:
        docs = [stage(spark, d, t).cache() for d, t in zip(docs, tables)]
        if "ids" not in docs[0].columns:
            assert docs[1].columns == [*docs[0].columns, *EXTRA] and docs[1].where(" or ".join(f"`{c}` <> 'x'" for c in EXTRA)).count() == 0
        plain, clashing = (sorted(map(repr, d.select(*docs[0].columns).collect())) for d in docs)
        assert plain == clashing and plain
