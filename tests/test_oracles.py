"""Every registered query against its SQL counterpart on DuckDB."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from tests.conftest import SF_DIR
from verification.oracles import ORACLES
from verification.queries import QUERIES

ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    yield connection
    connection.close()


def test_registry_is_complete():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck, sf_dir):
    frame = QUERIES[name](spark, sf_dir)
    columns = sorted(frame.columns)
    found = sorted(repr(tuple(r)) for r in frame.select(*columns).collect())
    if name in ROWS_ONLY:
        assert found
        return
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted(repr(tuple(r[i] for i in order)) for r in result.fetchall())
    assert found == expected


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0
