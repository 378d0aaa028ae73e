"""Every registered query against its DuckDB oracle on sf0.001 (rows-only where no oracle exists)."""

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE.get(name), SF)
    assert r["ok"] is not False, r


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["trip_id", "arrival_time", "departure_time", "stop_id", "stop_headsign", "stop_sequence",
                          "pickup_type", "drop_off_type"]
