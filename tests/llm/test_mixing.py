import pytest
from pyspark.sql import functions as F

from gtfsforge.llm.mixing import mix, ranked, targets
from gtfsforge.llm.queries_mixing import SQL_MIX, op8_mix_sources


def test_against_sql_with_nulls_and_repeats(spark, make_docs, against_sql):
    rows = [(i, " ".join(["w"] * (i * 7 % 23)), None, f"s{i % 5}") for i in range(300)]
    rows += [(400, None, None, "s1"), (401, "", None, None), (402, "a b c", None, None), (403, "a", None, ""), (404, "x\ty\x0bz q", None, "é")]
    rows += [(5, rows[5][1], None, "s0")] * 3
    got, want = against_sql(spark, op8_mix_sources, SQL_MIX, documents=make_docs(rows))
    assert got == want


def test_taken_comes_near_target(spark, make_docs):
    docs = make_docs([(i, " ".join(["w"] * (1 + i * i % 97)), None, f"s{i % 3}") for i in range(3000)])
    out = mix(docs)
    for r in out.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect():
        assert abs(r.t - r.g) <= 200
    assert out.where("taken > 2 * size or copies < 0").count() == 0
    assert sorted(map(tuple, out.select("doc_id", "taken").collect())) == sorted(map(tuple, mix(docs.repartition(7)).select("doc_id", "taken").collect()))


def test_targets_by_hand(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), ("c", 1000), (None, 50)], "source string, source_size long")
    got = {r.source: r.target for r in targets(sizes).collect()}
    # words 1160, shared 1740: weights a 5, b 2, c 1, null 5; a, b and null are full
    assert got == {"a": 20.0, "b": 200.0, None: 100.0, "c": 1420.0}


def test_empty_and_wordless(spark, make_docs):
    assert mix(make_docs([(1, "a", None, "s")]).limit(0)).count() == 0
    assert [(r.size, r.target, r.taken) for r in mix(make_docs([(1, None, None, "s"), (2, "", None, None)])).collect()] == [(0, 0.0, 0)] * 2


def test_clashing_names(spark, make_docs):
    docs = make_docs([(1, "a b", None, "s", 5, "k")], ", size long, rank string")
    assert [(r.doc_id, r.size) for r in mix(docs).collect()] == [(1, 2)]


@pytest.mark.parametrize("n", [0, 1, 1000])
def test_ranked(spark, n):
    got = ranked(spark.range(n).select(F.col("id"), ((F.col("id") * 7919) % 1009).alias("k")).repartition(5), "k", "id").collect()
    assert [r.id for r in sorted(got, key=lambda r: r.rank)] == [r.id for r in sorted(got, key=lambda r: (r.k, r.id))]
    assert sorted(r.rank for r in got) == list(range(n))
