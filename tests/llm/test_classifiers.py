from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmart.llm import noisy_channel as n
from tripmart.llm import quality_classifier as q
from tripmart.llm import toxicity as t
from tripmart.llm.common import table
from tripmart.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
LABEL = "doc_id long, quality int, toxic int"


def auc(labels, scores):
    order = np.argsort(np.argsort(scores, kind="stable"), kind="stable") + 1
    ones = labels == 1
    return (order[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())


def held_out(spark, query, column, folds, fold):
    rows = {r["doc_id"]: r for r in QUERIES[query](spark, SF).collect()}
    assert len(rows) == table(spark, SF, "documents").count()
    for r in rows.values():
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == fold)
    known = [(r[column], rows[r["doc_id"]]) for r in table(spark, SF, "labels").collect() if rows[r["doc_id"]]["held_out"]]
    return np.array([y for y, _ in known]), np.array([x["score"] for _, x in known])


def test_quality_on_held_out_rows(spark):
    labels, scores = held_out(spark, "op7_quality_classifier", "quality", 5, 0)
    assert auc(labels, scores) > 0.98
    assert (labels == (scores >= 0.3)).mean() > 0.95


def test_toxicity_on_held_out_rows(spark):
    labels, scores = held_out(spark, "op1_toxicity", "toxic", 4, 2)
    assert auc(labels, scores) > 0.8
    assert ((labels == 0) & (scores >= 0.3)).sum() <= 0.04 * (labels == 0).sum()


@pytest.fixture(scope="module")
def restorer(frame):
    text = "you are an idiot and a loser the worthless clown is stupid trash moron pathetic scum good little books that will tell all " * 40
    counts = n.character_counts(frame([(1, text), (2, text.upper()), (3, None)]))
    return n.Restorer(n.character_model(counts))


@pytest.mark.parametrize(
    ("token", "word"),
    [
        ("1d10t", "idiot"), ("l0s3r!!", "loser"), ("w0rthle$$", "worthless"), ("sttuuupid", "stupid"), ("m.o.r.o.n", "moron"),
        ("tr@sh", "trash"), ("cl0wn,", "clown"), ("ididiot", "ididiot"), ("books", "books"), ("12345", ""), ("---", ""), ("don't", "don't"),
        ("日本", "日本"), ("good***", "good"),
    ],
)
def test_restored_words(restorer, token, word):
    assert restorer.word(token) == word


@pytest.mark.parametrize(
    ("token", "word"),
    [
        ("iiddiioott", "idiot"), ("sccumm", "scum"), ("st-up-id", "stupid"), ("mo-ron", "moron"), ("id-i-ot", "idiot"),
        ("50(3", ""), ("1973", ""), ("will", "will"), ("little", "little"), ("tell", "tell"),
    ],
)
def test_letters_with_alternatives(restorer, token, word):
    assert restorer.word(token) == word


def test_look_alikes_alone(frame):
    counts = n.character_counts(frame([(1, "what a total ass and a big boss is it " * 50)]))
    assert n.Restorer(n.character_model(counts)).word("@$$") == "ass"


@pytest.mark.parametrize(
    ("text", "word"),
    [
        ("you i\td\ni\u00a0o  t ok", "idiot"), ("such s c u m there", "scum"),
        ("what a sc um he is", "scum"), ("you st up id man", "stupid"), ("an id iot", "idiot"), ("the st\nupid one", "stupid"),
    ],
)
def test_pieces_between_any_white_space(restorer, text, word):
    assert word in restorer.spaced(text)


def test_letters_of_the_corpus(frame):
    docs = frame([(1, "мудак и дурак " * 50), (2, "plain words " * 50)])
    letters = n.corpus_letters(docs)
    assert letters.startswith(n.LETTERS) and set("мудакр") <= set(letters)
    restorer = n.Restorer(n.character_model(n.character_counts(docs, letters)), letters=letters)
    assert restorer.word("д.у.р.а.к") == "дурак" and restorer.word("ддуурраакк") == "дурак"


def test_spaced_letters(restorer):
    assert "idiot" in restorer.spaced("you are i d i o t ok")
    assert restorer.spaced("a plain text") == []


def test_viterbi_finds_the_best_path(restorer):
    """Against all paths of a lattice."""

    def best(text):
        paths = [((), 0.0)]
        for options in restorer.lattice(text):
            paths = [(p + s, c + k) for p, c in paths for s, k in options]
        scored = []
        for path, cost in paths:
            x = y = 0
            for z in (*path, 0):
                cost += restorer.model[(x * n.SYMBOLS + y) * n.SYMBOLS + z]
                x, y = y, z
            scored.append((cost, "".join(n.LETTERS[z - 1] if z else " " for z in path).strip()))
        return max(scored)[1]

    for text in ("1d10t", "l0ss3rr", "b00k5", "a b c d", "w1ll", "t|e", "++1ll"):
        assert restorer.decode(text) == best(text)


KEYS = {"idi": 5.0, "idiot ": 6.0, "stup": 4.0, "worthless ": 7.0, "worth": 3.0, "ass ": 2.5, "scum ": 4.0, "мудак ": 3.0}


def test_scoring_decodes_all_that_matters(restorer):
    """Against decoding everything, on the words of a corpus in many disguises."""
    rnd = np.random.default_rng(5)
    words = "you are an idiot worthless stupid scum ass assess idiom worth stop the class good little мудак don't".split()
    other = {"i": "i1!|", "s": "s5$", "a": "a@4", "o": "o0", "e": "e3", "t": "t7+", "l": "l1|"}
    weigher = t.Weigher(KEYS)
    for _ in range(3000):
        text = ""
        for word in rnd.choice(words, 5):
            for c in word:
                text += str(rnd.choice(list(other.get(c, c)))) if rnd.random() < 0.3 else c
                text += c * int(rnd.integers(1, 4)) if rnd.random() < 0.1 else ""
                text += str(rnd.choice(list(".-*!'"))) if rnd.random() < 0.1 else ""
            text += str(rnd.choice(["", "!!", "...", "$"])) + " "
        full = {w for w in t.words_of(text, restorer) if weigher.word(w)}
        assert full <= weigher.words(text.lower(), restorer), text


@pytest.mark.parametrize("text", ["wor thl ess", "an id iot", "i d i o t", "1d10t", "id\ni\u00a00t", "w0r thl3 ss"])
def test_spaces_are_part_of_the_lattice(restorer, text):
    assert t.Weigher(KEYS).document(text, restorer)[0] >= 5


def test_clean_texts_give_hardly_any_words(restorer):
    weigher = t.Weigher(KEYS)
    assert weigher.words("good little books that will tell all 1973 12:30 a b c " * 50, restorer) == set()
    assert weigher.document("good little books", restorer) == [0.0, 0.0, 0.0]
    assert weigher.document(None, restorer) == [0.0, 0.0, 0.0] == t.Weigher({}).document("1d10t", restorer)


def test_long_stretches_are_walked_once(restorer):
    weigher = t.Weigher(KEYS)
    for text in ("1 " * 100_000, "1" * 100_000, "x " * 100_000, "st " * 50_000, "i.d" * 30_000):
        weigher.words(text, restorer)


def test_counts_cover_all_documents(frame):
    rows = [(i, "ab ba") for i in range(50)]
    counts = n.character_counts(frame(rows, 7))
    a, b = n.LETTERS.index("a") + 1, n.LETTERS.index("b") + 1
    assert counts[0, a, b] == 50 and counts[b, a, 0] == 50


def test_restored_documents(frame):
    counts = n.character_counts(frame([(1, "idiot loser " * 50)]))
    found = t.restored(frame([(1, "You 1d10t!"), (2, None)]), n.character_model(counts))
    assert {r["doc_id"]: r["restored"] for r in found.collect()} == {1: "you idiot", 2: ""}


def test_discriminant_equals_gaussian_densities(spark):
    rnd = np.random.default_rng(3)
    x = np.concatenate([rnd.normal(0, 1, (300, 3)), rnd.normal(1, 2, (200, 3))])
    y = [0] * 300 + [1] * 200
    rows = spark.createDataFrame([(k, c, v) for k, (c, v) in enumerate(zip(y, x.tolist(), strict=True))], "doc_id long, label int, x array<double>")
    model = q.fit(rows.repartition(5), 3, pooled=0.0, diagonal=0.0)
    logs = []
    for c in (0, 1):
        mine = x[np.array(y) == c]
        mean, cov = mine.mean(axis=0), np.cov(mine.T, bias=True)
        d = x - mean
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) - 0.5 * np.log(np.linalg.det(cov)))
    wanted = 1 / (1 + np.exp(-(logs[1] - logs[0] + np.log(200 / 300))))
    found = {r["doc_id"]: r["score"] for r in q.scored(rows, model).collect()}
    assert np.allclose([found[k] for k in range(500)], wanted, atol=1e-6)


@pytest.mark.parametrize("op", [q.op7_quality_classifier, t.op1_toxicity])
def test_odd_tables(spark, frame, op):
    rows = [(1, None), (2, ""), (3, "some words here"), (3, "some words here"), (4, "x" * 100_000), (5, "idiot " * 30_000)]
    docs = frame(rows).withColumns({c: F.lit(1) for c in ("label", "score", "x", "half")})
    labels = spark.createDataFrame([(1, 1, 0), (99, 0, 1), (3, None, None), (None, 1, 1)], LABEL)
    assert len(op(docs, labels).collect()) == 6
    assert len(op(docs, labels.limit(0)).collect()) == 6
    assert op(docs.limit(0), labels).collect() == []
    both = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 6)], LABEL)
    assert all(0 <= r["score"] <= 1 for r in op(docs, both).collect())
