"""Every registered query against its SQL on the smallest given tables."""

import os

import pytest

import __spark_entry__ as contract
from weektide.plans.workload import QUERIES, SQL, TABLES

duckdb = pytest.importorskip("duckdb")
FOLDER = os.environ.get("TEST_SF_DIR", contract.SMOKE_FOLDER)

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables are not there")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    yield con
    con.close()


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple((type(r[i]).__name__, repr(r[i])) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sql, name):
    df = contract.queries()[name](spark, FOLDER)
    cursor = sql.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical(df.columns, df.collect()) == canonical(columns, cursor.fetchall())


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_sql_has_its_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
