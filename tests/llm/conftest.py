import duckdb
import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table from rows (doc_id, text[, lang[, source]])."""

    def make(rows, extra=""):
        full = [(r + (None,) * (4 - len(r)) if len(r) < 4 else r) for r in rows]
        return spark.createDataFrame([(*r[:4], len(r[1]) if r[1] is not None else None, *r[4:]) for r in full], DOCS + extra)

    return make


@pytest.fixture(scope="session")
def against_sql(tmp_path_factory):
    """Rows of a query over given tables, and of its SQL in DuckDB over the same files."""

    def run(spark, query, sql, **tables):
        at = tmp_path_factory.mktemp("tables")
        con = duckdb.connect()
        for name, df in tables.items():
            df.write.parquet(f"{at}/{name}.parquet")
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{at}/{name}.parquet/*.parquet'")
        got = query(spark, str(at))
        want = con.execute(sql)
        names = [c[0] for c in want.description]
        assert sorted(names) == sorted(got.columns)
        norm = lambda r: tuple(round(x, 9) if isinstance(x, float) else x for x in r)
        key = lambda r: tuple((x is None, str(x)) for x in r)
        return sorted(map(norm, (tuple(r) for r in got.select(*names).collect())), key=key), sorted(map(norm, want.fetchall()), key=key)

    return run
