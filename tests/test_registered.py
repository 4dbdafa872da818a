"""Every registered query against its SQL, and at two shuffle widths."""

from concurrent.futures import ThreadPoolExecutor

import duckdb
import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for name in check.TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return connection


@pytest.fixture(scope="module")
def outcomes(spark, con):
    """All comparisons, several at a time: planning, not data, takes the time here."""

    def run(name):
        try:
            return check.compare(spark, con.cursor(), name, SF)
        except Exception as error:  # reported by the test of that query
            return False, repr(error)

    with ThreadPoolExecutor(6) as pool:
        return dict(zip(queries(), pool.map(run, queries())))


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_sql(outcomes, name):
    ok, note = outcomes[name]
    assert ok, note


@pytest.mark.parametrize("name", ["assign_batches", "insert_files", "upsert_status", "scan_collect", "visible_narrow_only"])
def test_partitioning_does_not_change_rows(spark, con, name):
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        ok, note = check.compare(spark, con, name, SF)
        assert ok, note
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_entry(spark):
    assert entry(spark).count() > 0


def test_checks_belong_to_queries():
    assert set(oracle_sql()) <= set(queries())
