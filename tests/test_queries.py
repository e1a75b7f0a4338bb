"""Every registered query against its SQL counterpart on the smallest tables."""

import duckdb
import pytest

import bench
from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, plain

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def test_entry(spark):
    assert entry(spark).count() == 100


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_bench_takes_all_text_operators():
    assert {n for n in queries() if n.startswith("op") or n == "pipeline"} <= set(bench.HEADLINE)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, db, name):
    ours = plain(queries()[name](spark, SF).toPandas())
    if name in oracle_sql():
        theirs = plain(db.sql(oracle_sql()[name]).df())
        assert list(ours.columns) == list(theirs.columns)
        assert ours.equals(theirs)


def test_manifest_grows_with_its_table(spark, db):
    larger = SF.replace("sf0.001", "sf0.01")
    folders = [queries()["manifest_by_keys"](spark, sf).count() for sf in (SF, larger)]
    assert folders[1] > folders[0]
