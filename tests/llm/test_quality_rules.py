from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from samples import corpus

from tripmart.llm import quality_rules as q
from tripmart.llm.oracles import OP10

NOISE = [
    (1, "Home | About | Contact | Terms | Login\n" * 30),
    (2, ("A clean line of plain words that ends well, number %d.\n" % 7) + " ".join(f"word{i}" for i in range(80)) + "."),
    (3, "STOP!! LOOK!! LISTEN!! " * 30),
    (4, " ".join(f"tok{i}###" for i in range(90))),
    (5, "All rights reserved.\n" + " ".join(f"tok{i}" for i in range(90)) + "."),
    (6, "same line here again\n" * 40),
]


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


@pytest.fixture(scope="module")
def rows():
    return corpus(1, 40) + [(20_000 + i, t) for i, t in NOISE]


def test_equal_to_sql(frame, sql, result, rows):
    assert result(q.op10_quality_rules(frame(rows))) == sql(OP10, rows)


def test_figures_equal_brute_force(frame, rows):
    texts = dict(rows)
    for r in q.op10_quality_rules(frame(rows)).collect():
        found = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert found == brute(texts[r["doc_id"]]), r["doc_id"]


def test_verdicts(frame, rows):
    kept = {r["doc_id"]: r["kept"] for r in q.op10_quality_rules(frame(rows)).collect()}
    assert [kept[20_000 + i] for i in range(1, 7)] == [False, True, False, False, True, False]


def test_kept_documents_come_as_they_were(frame, rows, result):
    docs = frame(rows)
    kept = q.kept_documents(docs)
    wanted = {r["doc_id"] for r in q.op10_quality_rules(docs).where("kept").collect()}
    assert kept.columns == docs.columns
    assert result(kept) == result(docs.where(F.col("doc_id").isin(list(wanted))))


def test_clashing_columns_nulls_and_empty_table(spark, frame):
    docs = frame([(1, None), (2, NOISE[1][1]), (2, NOISE[1][1])])
    clash = docs.withColumns({c: F.lit("x") for c in ("n_words", "kept", "words", "KEPT2", "_lines", "lines", "base_failed")})
    kept = q.kept_documents(clash)
    assert kept.columns == clash.columns
    assert [r["doc_id"] for r in kept.collect()] == [2, 2]
    assert q.op10_quality_rules(docs.limit(0)).collect() == []


def test_native_plan(frame):
    plan = q.kept_documents(frame([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange hash" not in plan
