"""Every registered query against its SQL on the smallest fixture."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check import plain
from workload.queries import QUERIES, TABLE_NAMES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="fixture tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLE_NAMES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    df = queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted(map(str, [[plain(r[c]) for c in columns] for r in df.collect()]))
    assert name in oracle_sql(), "every query here has an SQL counterpart"
    result = db.execute(oracle_sql()[name])
    header = [d[0] for d in result.description]
    assert sorted(header) == columns
    want = sorted(map(str, [[plain(r[header.index(c)]) for c in columns] for r in result.fetchall()]))
    assert got == want and got


def test_entry(spark):
    assert entry(spark).count() > 0
