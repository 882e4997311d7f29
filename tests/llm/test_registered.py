"""Registered queries on documents against their SQL counterparts, over whole tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from tripmart.llm.oracles import ORACLES
from tripmart.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = driver.queries()
    assert [n for n in range(1, 14) if not any(x.startswith(f"op{n}_") for x in names)] == []
    assert names["pipeline"] is corpus_pipeline.run and len(corpus_pipeline.STAGES) == 5
    assert set(ORACLES) <= set(QUERIES) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(name, spark, result, sql_tables):
    assert result(QUERIES[name](spark, SF)) == sql_tables(ORACLES[name])


@pytest.fixture(scope="module")
def sql_tables():
    base = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        base.execute(f"create view {os.path.basename(path).removesuffix('.parquet')} as select * from '{path}'")

    def run(query):
        found = base.execute(query)
        names = [d[0] for d in found.description]
        rows = [dict(zip(names, r, strict=True)) for r in found.fetchall()]
        return sorted((tuple(sorted(r.items())) for r in rows), key=repr)

    return run
