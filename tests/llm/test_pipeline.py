from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from test_decontamination import ITEM
from test_ngram_join import brute as brute_join
from test_quality_rules import brute as brute_rules
from test_substring_dedup import brute as brute_repeats
from test_tokens import WORD, check_packing, library

import corpus_pipeline as c
from tripmart.llm import decontamination, quality_rules
from tripmart.llm.common import terms


@pytest.fixture(scope="module")
def corpus_dir(spark, frame, tmp_path_factory):
    rnd = random.Random(1)
    words = [f"w{i}" for i in range(2000)]

    def line(k):
        return " ".join(rnd.choice(words) for _ in range(k)) + "."

    passage = line(60)
    item = line(30)
    texts = ["\n".join(line(rnd.randint(8, 14)) for _ in range(rnd.randint(6, 16))) for _ in range(40)]
    texts += [t.replace("w1", "v1", 1) for t in texts[:10]] + texts[10:14]
    texts += [f"{line(60)}\n{passage}\n{line(60)}" for _ in range(5)]
    texts += [f"{line(60)}\n{item}\n{line(20)}" for _ in range(3)]
    texts += ["a | b | c | d\n" * 40, None, "", line(20)]
    rows = list(enumerate(texts))
    folder = str(tmp_path_factory.mktemp("corpus"))
    frame(rows, 3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, "no such words")], ITEM).write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, passage, item


def test_stages_equal_brute_force(spark, corpus_dir):
    folder, rows, passage, item = corpus_dir
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    texts = dict(rows)
    for k, (name, stage) in enumerate(c.STAGES):
        after = c.written(spark, stage(spark, docs, folder), "t")
        if k < 4:
            assert after.columns == columns, name
            found = {r["doc_id"]: r["text"] for r in after.collect()}
            assert all(r["n_chars"] == len(r["text"]) for r in after.collect())
        if k == 0:
            kept = {r["doc_id"]: r["kept"] for r in quality_rules.op10_quality_rules(docs).collect()}
            for i, t in texts.items():
                n_words, *_, repeated = brute_rules(t)
                assert not kept[i] or (n_words >= 50 and 2 * repeated <= n_words)
            assert found == {i: t for i, t in texts.items() if kept[i]} and len(found) < len(texts)
        if k == 1:
            groups = brute_join(list(texts.items()), 80, 5)
            assert found == {i: texts[i] for i, _, first in groups if i == first} and len(found) < len(texts)
        if k == 2:
            counts = brute_repeats(list(texts.items()))
            assert {i: len(t.split()) for i, t in found.items()} == {i: n - gone for i, (n, gone, _) in counts.items() if gone < n}
            assert sum(passage in t for t in found.values()) == 1
        if k == 3:
            marked = {r["doc_id"] for r in decontamination.op3_decontamination(docs, spark.read.parquet(f"{folder}/benchmark.parquet")).where("contaminated").collect()}
            windows = {tuple(terms(item)[i : i + 13]) for i in range(len(terms(item)) - 12)}
            for i, t in texts.items():
                w = terms(t)
                hit = {x + y for x in range(len(w) - 12) if tuple(w[x : x + 13]) in windows for y in range(13)}
                assert (i in marked) == bool(hit and 20 * len(hit) >= len(w))
            assert found == {i: t for i, t in texts.items() if i not in marked} and marked
        if k == 4:
            ids = library(WORD, list(texts.values()))
            check_packing(after.collect(), {i: [*x, 1] for i, x in zip(texts, ids, strict=True)}, 4096)
        docs = after
        if k < 4:
            texts = found


def test_run_applies_all_stages(spark, corpus_dir):
    folder = corpus_dir[0]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in c.STAGES:
        docs = c.written(spark, stage(spark, docs, folder), "t")
    order = ["doc_id", "piece"]
    whole = c.run(spark, folder)
    assert whole.drop("sequence_id", "offset").orderBy(order).collect() == docs.drop("sequence_id", "offset").orderBy(order).collect()


def test_empty_table(spark, corpus_dir, tmp_path):
    folder = corpus_dir[0]
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert c.run(spark, str(tmp_path)).collect() == []


def test_no_stage_adds_or_loses_columns(spark, corpus_dir):
    folder = corpus_dir[0]
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumns({x: F.lit(1) for x in ("kept", "v", "n", "hits", "key")})
    for _, stage in c.STAGES[:-1]:
        docs = c.written(spark, stage(spark, docs, folder), "t")
        assert docs.columns[-5:] == ["kept", "v", "n", "hits", "key"]
