"""Every registered query next to its SQL on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from tools.compare import TABLES, canonical

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="tables not present")


@pytest.fixture(scope="module")
def con():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, str(SF))
    cur = con.execute(entry.oracle_sql()[name])
    assert canonical(df.columns, df.collect()) == canonical([d[0] for d in cur.description], cur.fetchall())
    spark.catalog.clearCache()


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
