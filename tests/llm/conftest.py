from __future__ import annotations

import duckdb
import pytest

from tripmart.llm.common import prepare

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    prepare(spark)


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (id, text) pairs, in several partitions."""

    def make(rows, parts=3):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCUMENT).repartition(parts)

    return make


@pytest.fixture(scope="session")
def sql():
    """Rows of an oracle over (id, text) documents and further tables."""

    def run(query, rows, **tables):
        base = duckdb.connect()
        base.execute("create table documents (doc_id bigint, text varchar)")
        if rows:
            base.executemany("insert into documents values (?, ?)", [list(r) for r in rows])
        for name, (columns, content) in tables.items():
            base.execute(f"create table {name} ({columns})")
            if content:
                base.executemany(f"insert into {name} values ({', '.join('?' * len(content[0]))})", [list(r) for r in content])
        found = base.execute(query)
        names = [d[0] for d in found.description]
        return rows_of([dict(zip(names, r, strict=True)) for r in found.fetchall()])

    return run


def rows_of(rows):
    """Rows as sorted tuples of name and value."""
    return sorted((tuple(sorted(r.items())) for r in rows), key=repr)


@pytest.fixture(scope="session")
def result():
    return lambda found: rows_of([r.asDict(recursive=True) for r in found.collect()])
