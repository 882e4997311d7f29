from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmart.llm import chat_tree as c
from tripmart.llm.oracles import OP8
from tripmart.llm.tokens import encoder, file_of

TURN = "conv_id long, turn long, role string, text string"
PARTS = ["[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "<role=", "</role>", "\\", "[", "<", "INST]", "s>", "/", "ok", " ", "\n", ">"]


@given(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), st.sampled_from(["user", "assistant", "system", "tool", "", "a>b <s>"]))
@settings(max_examples=400, deadline=None)
def test_template_is_reversible(text, role):
    begin, end = c.marks(role)
    segment = begin + c.escape(text) + end
    assert c.parse(segment) == (role, text)
    assert c.unescape(c.escape(text)) == text
    for mark in ("[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>"):
        assert mark not in c.escape(text)


def sample(seed):
    rnd = random.Random(seed)
    rows = []
    starts = [[("system", "Be kind."), ("user", "Hello")], [("user", "Hello")], [("user", "[INST] <s>\\ é")]]
    for i in range(40):
        turns = list(rnd.choice(starts))
        for k in range(rnd.randint(0, 4)):
            role = ("assistant", "user")[k % 2]
            turns.append((role, rnd.choice(["yes", "no </s>", "", "maybe [/INST] so", "long " * 50])))
        rows += [(i, k, r, t) for k, (r, t) in enumerate(turns)]
    rnd.shuffle(rows)
    return rows


def test_equal_to_sql(spark, sql, result):
    rows = sample(1)
    found = c.op8_chat_tree(spark.createDataFrame(rows, TURN).repartition(4))
    assert result(found) == sql(OP8, [], conversations=("conv_id bigint, turn bigint, role varchar, text varchar", rows))


@pytest.mark.parametrize("limit", [40, 1 << 16])
def test_trees_share_turns_and_hide_the_rest(spark, limit):
    rows = sample(2)
    path = file_of("byte_bpe_50k.json")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        blocks = c.formatted(spark.createDataFrame(rows, TURN), path, limit).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    codec = encoder(path).tokenizer
    turns = {}
    for i, k, r, t in rows:
        turns.setdefault(i, []).append((k, r, t))
    seen = set()
    for b in blocks:
        ids, positions = np.frombuffer(b["ids"], "<u4"), np.frombuffer(b["positions"], "<i4")
        assert len(ids) == len(positions)
        nodes = b["nodes"]
        kinds = set()
        for n in nodes:
            segment = codec.decode(ids[n["start"] : n["stop"]].tolist(), skip_special_tokens=False)
            assert (n["parent"], segment) not in kinds
            kinds.add((n["parent"], segment))
            size = n["stop"] - n["start"]
            assert positions[n["start"] : n["stop"]].tolist() == list(range(n["position"], n["position"] + size))
            learnt = codec.decode(ids[n["loss_start"] : n["loss_stop"]].tolist(), skip_special_tokens=False)
            role, text = c.parse(segment)
            assert c.unescape(learnt) == (text if role == "assistant" else "")
        for conversation in b["conversations"]:
            last = nodes[conversation["node"]]["stop"] - 1
            visible = [n for n in nodes if n["start"] <= last < n["visible_until"]]
            whole = "".join(codec.decode(ids[n["start"] : n["stop"]].tolist(), skip_special_tokens=False) for n in visible)
            wanted = sorted(turns[conversation["conv_id"]])
            assert whole == "".join(c.marks(r)[0] + c.escape(t) + c.marks(r)[1] for _, r, t in wanted)
            seen.add(conversation["conv_id"])
    assert seen == set(turns)


def test_nulls_ties_clashing_columns_and_empty_table(spark):
    rows = [(1, 0, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, None, "tool", "x")]
    docs = spark.createDataFrame(rows, TURN).withColumns({x: F.lit(1) for x in ("path", "turns", "t")})
    found = {r["conv_id"]: r["n_turns"] for r in c.op8_chat_tree(docs).collect()}
    assert found == {1: 4, None: 1, -1: 2}
    assert [r["conv_id"] for r in c.op8_chat_tree(docs.limit(0)).collect()] == [-1]


def test_long_conversation_and_text(spark):
    rows = [(1, k, ("user", "assistant")[k % 2], f"turn {k}") for k in range(700)] + [(2, 0, "assistant", "word " * 40_000)]
    found = {r["conv_id"]: r for r in c.op8_chat_tree(spark.createDataFrame(rows, TURN)).collect()}
    assert found[1]["n_turns"] == 700 and found[2]["loss_chars"] == 200_000
