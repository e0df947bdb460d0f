"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as registry
from trendmill.workload import bronze_cases, gold_cases, pipeline_cases, quality_cases, silver_cases

SF_DIR = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        con.execute(f"create view {file.removesuffix('.parquet')} as select * from '{SF_DIR}/{file}'")
    return con


def _sorted(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=lambda r: [(v is None, str(v)) for v in r])


NAMES = [name for cases in (bronze_cases, silver_cases, gold_cases, quality_cases, pipeline_cases) for name in cases.QUERIES]


def test_every_query_has_sql():
    assert set(NAMES) <= registry.queries().keys()
    assert set(NAMES) <= registry.oracle_sql().keys()
    assert registry.oracle_sql().keys() <= registry.queries().keys()


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, oracle, name):
    df = registry.queries()[name](spark, SF_DIR)
    expected = oracle.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in expected.description]
    assert sorted(df.columns) == sorted(columns)
    assert _sorted([tuple(r) for r in df.collect()], df.columns) == _sorted(expected.fetchall(), columns)


def test_entry(spark):
    rows = registry.entry(spark).collect()
    assert [r.rank_in_region for r in rows] == list(range(1, len(rows) + 1))
    views = [r.total_views for r in rows]
    assert views == sorted(views, reverse=True)
