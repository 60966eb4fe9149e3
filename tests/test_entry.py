"""Driver contract and DuckDB oracle agreement on the smallest fixtures."""

import duckdb
import pytest

import __spark_entry__ as E
from lakepipe.plans import catalog
from lakepipe.plans.fixtures import TABLES
from tools.check_oracle import digest

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "daily_revenue" in df.columns


def test_every_query_has_an_oracle():
    assert set(catalog.oracle_sql()) == set(catalog.queries())
    assert len(catalog.queries()) >= 78
    assert set(catalog.queries()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_oracle_agrees(spark, duck, name):
    sc, sn, sh, srows = digest(E.queries()[name](spark, SF).toPandas())
    dc, dn, dh, drows = digest(duck.execute(E.oracle_sql()[name]).fetchdf())
    assert sc == dc
    assert sn == dn
    assert sh == dh, (sorted(set(srows) - set(drows))[:3], sorted(set(drows) - set(srows))[:3])


def test_queries_are_listed_without_a_session():
    import subprocess
    import sys

    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    assert subprocess.run([sys.executable, "-c", code], cwd=E.__file__.rsplit("/", 1)[0], capture_output=True).returncode == 0
