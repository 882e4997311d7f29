from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import corpus

from tripmart.llm import decontamination as d
from tripmart.llm.common import terms, word_hashes
from tripmart.llm.oracles import OP3

ITEM = "item_id long, text string"


def items(rows, seed=0):
    rnd = random.Random(seed)
    texts = [t for _, t in rows if t and len(terms(t)) > 20]
    found = []
    for i in range(12):
        words = [w.decode() for w in terms(rnd.choice(texts))]
        at = rnd.randint(0, len(words) - 14)
        found.append((i, " ".join(words[at : at + rnd.randint(2, 30)])))
    return found + [(50, None), (51, ""), (52, "one"), (53, "?!"), (2, "nowhere to be found"), (1, found[1][1].upper())]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equal_to_sql(spark, frame, sql, result, seed):
    rows = corpus(seed, 50, 30)
    bench = items(rows, seed)
    found = d.op3_decontamination(frame(rows), spark.createDataFrame(bench, ITEM))
    assert result(found) == sql(OP3, rows, benchmark=("item_id bigint, text varchar", bench))


def test_blocks_and_small_shards_give_the_same(spark, frame):
    rows = corpus(4, 40, 30)
    bench = spark.createDataFrame(items(rows, 4), ITEM)
    one, names = d.matches(frame(rows), bench)
    many, _ = d.matches(frame(rows), bench, block_bytes=60, shard_words=100)

    def spans(found):
        return {r["doc_id"]: (sorted(map(tuple, r[names["hits"]])), r[names["items"]]) for r in found.collect()}

    assert spans(one) == spans(many)


def test_longest_match_has_its_places(spark, frame):
    passage = " ".join(f"p{i}" for i in range(20))
    docs = frame([(1, f"x y {passage} z"), (2, "nothing")])
    bench = spark.createDataFrame([(7, f"before {passage} after")], ITEM)
    found, names = d.matches(docs, bench)
    best = {r["doc_id"]: r[names["longest"]] for r in found.collect()}
    assert tuple(best[1]) == (20, 2, "7", 1) and best[2] is None


@pytest.mark.parametrize("limits", [{}, {"block_bytes": 60, "shard_words": 100}])
def test_longest_match_of_every_document(spark, frame, limits):
    """Against brute force, with copies of a passage in one shard."""
    rows = corpus(6, 30, 30)
    rows += [(1000 + i, rows[k][1]) for i, k in enumerate([3, 3, 3, 7, 7, 11])] + [(2000, None), (2001, "")]
    bench = items(rows, 6)
    listed = {}
    for i, text in bench:
        listed.setdefault(str(i), []).append(terms(text))

    def matched(a, b):
        k = 0
        while k < min(len(a), len(b)) and a[k] == b[k]:
            k += 1
        return k

    found, names = d.matches(frame(rows, 3), spark.createDataFrame(bench, ITEM), **limits)
    texts, seen = dict(rows), 0
    for r in found.collect():
        words = terms(texts[r["doc_id"]])
        suffixes = [b[j:] for texts_ in listed.values() for b in texts_ for j in range(len(b))]
        lengths = [max((matched(words[a:], x) for x in suffixes), default=0) for a in range(len(words))]
        best = max(lengths, default=0)
        if best < 2:
            assert r[names["longest"]] is None
            continue
        seen += 1
        length, start, item, place = r[names["longest"]]
        assert (length, start) == (best, lengths.index(best))
        assert any(b[place : place + best] == words[start : start + best] for b in listed[item])
    assert seen > 10


def test_suffix_array_is_sorted():
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 40))) for _ in range(30)]
    array = d.SuffixArray([word_hashes(terms(t)) for t in texts], 64)
    words = array.words.tolist()
    seen = [tuple(words[i : (words + [0]).index(0, i)]) for i in array.order.tolist() if words[i]]
    assert seen == sorted(seen)
    assert sorted(array.order.tolist()) == list(range(array.size))


def test_clean_documents_keep_their_columns(spark, frame):
    passage = " ".join(f"p{i}" for i in range(13))
    docs = frame([(1, passage), (2, None), (3, passage + " x" * 300), (1, passage)])
    clash = docs.withColumns({c: F.lit("k") for c in ("n_words", "hits", "items", "Longest")})
    clean = d.clean_documents(clash, spark.createDataFrame([(1, passage)], ITEM))
    assert clean.columns == clash.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == [2, 3]
    assert d.op3_decontamination(docs.limit(0), spark.createDataFrame([], ITEM)).collect() == []
    none = d.op3_decontamination(docs, spark.createDataFrame([], ITEM)).collect()
    assert len(none) == 4 and not any(r["contaminated"] for r in none)


def test_ranks_of_unknown_words():
    array = d.SuffixArray([word_hashes([b"a", b"b"])], 4)
    ranks = array.ranks(word_hashes([b"a", b"zzz", b"b"]))
    assert ranks[1] == -1 and (ranks[[0, 2]] > 0).all()
    assert isinstance(ranks, np.ndarray)
