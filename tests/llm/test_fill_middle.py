from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from samples import corpus

from tripmart.llm import fill_middle as f
from tripmart.llm.common import text_bytes
from tripmart.llm.oracles import OP12

LETTERS = ["a", "bc", "é", "日本", " ", "\n", "<", "<P", "P>", ">", "<S", "1", "😀", "S>", "M>", "\x00"]


def brute(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(LETTERS) for _ in range(rnd.randint(0, 30))) for _ in range(1500)]
    texts += ["", None, "<P>", "x" * 300_000, "1" * 100_000, "word " * 120_000] + [t for _, t in corpus(5)]
    return [(rnd.randint(-5, 10**9), t) for t in texts] + [(None, "no id"), (7, "same"), (7, "same"), (7, "other")]


def test_turned_and_restored_as_by_slices(frame, rows):
    docs = frame(rows).withColumns({"n": F.lit("x"), "Output": F.lit(1), "form_": F.lit(2)})
    turned = f.fill_in_middle(docs)
    found = sorted((tuple(r) for r in turned.collect()), key=repr)
    assert found == sorted(((i, *brute(i, t)) for i, t in rows), key=repr)
    back = f.restored(turned.withColumns({"restored": F.lit(3), "output_": F.lit(4)}))
    texts = [(r["doc_id"], r["_restored"]) for r in back.collect()]
    assert sorted(texts, key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)


def test_query(frame, rows, result, sql):
    small = [r for r in rows if r[1] is None or "\x00" not in r[1]]
    assert result(f.op12_fill_in_middle(frame(small))) == sql(OP12, small)


def test_forms_are_shared_out(rows):
    forms = [brute(i, "some text of words")[1] for i in range(4000)]
    assert 0.07 < forms.count("plain") / 4000 < 0.13 and 0.15 < forms.count("spm") / 4000 < 0.21


def test_empty_table(frame):
    assert f.op12_fill_in_middle(frame([])).collect() == []


def test_outputs_that_no_text_has():
    outputs = ["<P>a<S>b<M>c", "<P>a<S>b", "<S>a<P>b<M>c", "<P><P>a<S>b<M>c", "x<P>a<S>b<M>c", "<M><P>a<S>b", "", "<P>", None]
    data, begins = text_bytes(pa.array(outputs, type=pa.string()))
    found = f.undo(data, begins, ["psm"] * 7 + ["plain", "psm"], f.Rules()).to_pylist()
    assert found == ["acb", None, None, None, None, None, None, "<P>", None]


def test_markers_that_overlap_are_refused():
    for markers in (("ab", "ba", "c"), ("a", "ab", "c"), ("aa", "b", "c"), ("", "b", "c"), ("a", "a", "b")):
        with pytest.raises(ValueError):
            f.Rules(markers=markers)


def test_other_rules():
    rules = f.Rules(turned=100, suffix_first=100, seed="x", markers=("<a>", "<bb>", "<ccc>"))
    texts = ["some words, here", "<P> <S>", "<bb>"]
    data, begins = text_bytes(pa.array(texts))
    out = f.turn(data, begins, [1, 2, 3], rules)
    assert out["form"].to_pylist() == ["spm", "spm", "plain"]
    data, begins = text_bytes(out["output"])
    assert f.undo(data, begins, out["form"].to_pylist(), rules).to_pylist() == texts


def test_shifts_of_empty_parts():
    assert f.shifts(np.array([0, 0, 2, 2]), np.array([5, 1, 7, -2]), 4).tolist() == [1, 1, -2, -2]
