"""Every registered query against the checking SQL, over the whole smallest test data."""

import math
import os
from pathlib import Path

import pytest

from voltlog.plans import catalog

duckdb = pytest.importorskip("duckdb")
SF_DIR = Path(os.environ.get("VOLTLOG_TEST_SF_DIR", "/root/testdata/sf0.001"))
QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test data")


@pytest.fixture(scope="module")
def checker():
    with duckdb.connect() as connection:
        connection.execute(f"CREATE VIEW events AS SELECT * FROM '{SF_DIR}/events.parquet'")
        yield connection


def normal(rows):
    return sorted(
        (tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in row) for row in rows),
        key=repr,
    )


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, checker, name):
    got = QUERIES[name](spark, str(SF_DIR))
    names = sorted(got.columns)
    result = checker.execute(ORACLES[name])
    assert sorted(c[0] for c in result.description) == names
    order = [[c[0] for c in result.description].index(n) for n in names]
    expected = normal(tuple(row[i] for i in order) for row in result.fetchall())
    rows = normal(tuple(row) for row in got.select(*names).collect())
    assert len(rows) == len(expected)
    assert rows == expected
