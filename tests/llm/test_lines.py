from pyspark.sql import functions as F

from gtfsforge.llm.line_dedup import line_dedup, spread_lines
from gtfsforge.llm.queries_lines import SQL_LINES, op5_line_dedup

FOOT = "subscribe to our letter today"


def rows():
    out = [(i, f"own line number {i}\n {FOOT}\t\nlast words of {i}", None, f"s{i % 7}") for i in range(40)]
    out += [(100 + i, f"shared by four sites only\n{FOOT}", None, f"s{i % 4}") for i in range(12)]
    out += [(200 + i, f"{FOOT}\n{FOOT}", None, f"s{i}") for i in range(6)]
    out += [(300, None, None, "s1"), (301, "", None, "s2"), (302, "\n\n", None, None), (303, FOOT, None, None), (304, "two words", None, "s9")]
    out += [(400 + i, "exactly five sites here\ntwo words", None, f"s{i}") for i in range(5)]
    return out


def test_against_sql(spark, make_docs, against_sql):
    got, want = against_sql(spark, op5_line_dedup, SQL_LINES, documents=make_docs(rows()))
    assert got == want


def test_an_empty_source_is_a_site(spark, make_docs, against_sql):
    docs = make_docs(rows() + [(500 + i, f"on five sites with an empty one\nown line number {i}", None, s) for i, s in enumerate(["", "a", "b", "c", "d"])])
    got, want = against_sql(spark, op5_line_dedup, SQL_LINES, documents=docs)
    assert got == want
    assert {r.doc_id: r.n_removed for r in line_dedup(docs).where("doc_id >= 500").collect()} == {500: 0, 501: 1, 502: 1, 503: 1, 504: 1}


def test_first_occurrence_stays_and_clean_documents_are_left(spark, make_docs):
    out = {r.doc_id: r for r in line_dedup(make_docs(rows())).collect()}
    assert out[0].n_removed == 0 and FOOT in out[0].text
    assert out[1].text == "own line number 1\nlast words of 1"
    assert out[100].text == "shared by four sites only" and out[203].text == "" and out[203].n_removed == 2
    assert out[300].text is None and out[301].text == "" and out[302].text == "\n\n" and out[304].text == "two words"
    # short lines too: 304 has the first of six sites
    assert out[400].text == "exactly five sites here" and out[401].text == "" and out[401].n_removed == 2
    kept = {r.doc_id: r.text for r in line_dedup(make_docs(rows()), min_words=3).collect()}
    assert kept[400] == "exactly five sites here\ntwo words" and kept[401] == "two words"


def test_near_threshold_lines_are_counted_exactly(spark):
    lines = spark.range(60_000).select(
        (F.col("id") % 300).alias("h1"), F.lit(0).cast("long").alias("h2"), F.col("id").alias("doc_id"), F.col("id").alias("rk"), F.lit(0).alias("pos"),
        F.concat(F.lit("s"), F.expr("(id div 300) % (100 + id % 300 % 100)")).alias("site"),
    )
    want = {r.h1 for r in lines.groupBy("h1").agg(F.countDistinct("site").alias("n")).where("n >= 150").collect()}
    assert {r.h1 for r in spread_lines(lines, 150).collect()} == want and 0 < len(want) < 300


def test_repeated_rows_empty_table_and_extra_columns(spark, make_docs):
    docs = make_docs([(*r, "keep", 3) for r in rows()] + [(*rows()[1], "keep", 3)] * 2, ", line string, gone int")
    out = line_dedup(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_removed"] and out.count() == docs.count()
    assert [r.text for r in out.where("doc_id = 1").collect()] == ["own line number 1\nlast words of 1"] * 3
    assert line_dedup(docs.limit(0)).count() == 0
