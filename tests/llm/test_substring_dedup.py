from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F
from samples import corpus

from tripmart.llm import substring_dedup as m
from tripmart.llm.oracles import OP2


def brute(rows, window=13):
    first = {}
    words = {i: (t or "").encode().split() for i, t in rows}
    for i, w in words.items():
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone |= set(range(k, k + window))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out[i] = (len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("vocabulary", [4, 40, 400])
def test_equal_to_brute_force(frame, seed, vocabulary):
    rows = corpus(seed, 50, vocabulary)
    found = {r["doc_id"]: tuple(r)[1:] for r in m.op2_substring_dedup(frame(rows, seed)).collect()}
    assert found == brute(rows)


def test_equal_to_sql(frame, sql, result):
    rows = corpus(9, 60, 60)
    assert result(m.op2_substring_dedup(frame(rows))) == sql(OP2, rows)


def test_common_short_line_with_many_contexts(frame):
    rnd = random.Random(5)
    line = "this is one very common line of ten words here"
    rows = [(i, " ".join(f"a{rnd.randint(0, 999)}" for _ in range(20)) + f" {line} " + " ".join(f"b{rnd.randint(0, 999)}" for _ in range(20))) for i in range(80)]
    rows += [(100 + i, rows[i][1].split(" ", 12)[-1]) for i in range(0, 80, 9)]
    found = {r["doc_id"]: tuple(r)[1:] for r in m.op2_substring_dedup(frame(rows, 5)).collect()}
    assert found == brute(rows)


def test_null_ids_repeated_rows_versions_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text), (None, text), (5, text), (5, text), (5, text + " more"), (3, text), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(((r["doc_id"], r["n_removed"]) for r in m.op2_substring_dedup(docs).collect()), key=repr)
    assert found == sorted([(None, 0), (None, 0), (None, 0), (3, 0), (5, 30), (5, 30), (5, 30)], key=repr)
    assert m.op2_substring_dedup(docs.limit(0)).collect() == []


def test_texts_are_cut_in_place(frame):
    passage = " ".join(f"p{i}" for i in range(15))
    rows = [(1, f"alpha\n{passage}\nomega"), (2, f"first line\n{passage}  last\tword"), (3, "un touched\n text "), (4, passage)]
    clash = frame(rows).withColumns({c: F.lit(1) for c in ("_cut", "v", "_d", "_version", "start", "_stretches")})
    cut, mark = m.without_repeats(clash)
    assert cut.columns == [*clash.columns, mark]
    assert {r["doc_id"]: (r["text"], r[mark]) for r in cut.collect()} == {
        1: (rows[0][1], False),
        2: ("first line\nlast\tword", True),
        3: (rows[2][1], False),
        4: ("", True),
    }


def test_maximal_stretches():
    spans = [{"start": 5, "stop": 18}, {"start": 0, "stop": 3}, {"start": 17, "stop": 30}, {"start": 30, "stop": 43}]
    assert m.maximal(spans) == [(0, 3), (5, 43)]
    assert m.maximal(None) == []


def test_crowded_anchors_change_nothing(frame, monkeypatch):
    """Every anchor that a batch has twice, dealt by content."""
    monkeypatch.setattr(m, "SEVERAL", 1)
    monkeypatch.setattr(m, "CROWDED", 0)
    for vocabulary in (4, 60):
        rows = corpus(7, 50, vocabulary)
        found = {r["doc_id"]: tuple(r)[1:] for r in m.op2_substring_dedup(frame(rows, 4)).collect()}
        assert found == brute(rows)
