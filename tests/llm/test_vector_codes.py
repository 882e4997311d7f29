from __future__ import annotations

import hashlib
import random
from fractions import Fraction
from math import floor, isfinite

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmart.llm import vector_codes as v
from tripmart.llm.oracles import OP11

SCHEMA = "vec_id long, embedding array<float>, label int"


def slow_nearest(part, entries):
    found = [sum((a - b) ** 2 for a, b in zip(part, e, strict=True)) for e in entries]
    return found.index(min(found)), min(found)


def brute(rows, positions=4, entries=256, rounds=4):
    kept = [r for r in rows if r[1] is not None and all(x is not None and isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    length = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == length]
    width = -(-length // positions)
    whole = [[floor(Fraction(float(np.float32(x))) * 1024) for x in r[1]] + [0] * (positions * width - length) for r in kept]
    parts = [[w[p * width : (p + 1) * width] for p in range(positions)] for w in whole]
    books = [[tuple(x[p]) for x in parts[:entries]] for p in range(positions)]
    for _ in range(rounds):
        for p in range(positions):
            groups = {}
            for x in parts:
                groups.setdefault(slow_nearest(x[p], books[p])[0], []).append(x[p])
            for e, some in groups.items():
                books[p][e] = tuple(sum(c) // len(some) for c in zip(*some, strict=True))
    found = [[slow_nearest(x[p], books[p]) for p in range(positions)] for x in parts]
    errors = [sum(d for _, d in f) for f in found]
    labels = {}
    for r, e in zip(kept, errors, strict=True):
        labels[r[2]] = labels.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [
        (r[0], "".join(f"{i:02x}" for i, _ in f), e, labels[r[2]], digest)
        for r, f, e in zip(kept, found, errors, strict=True)
    ]


def made(seed, n, width=8, spread=0.02):
    rnd = random.Random(seed)
    centres = [[rnd.uniform(-1, 1) for _ in range(width)] for _ in range(12)]
    rows = []
    for i in range(n):
        x = [float(np.float32(c + rnd.gauss(0, spread))) for c in rnd.choice(centres)]
        rows.append((i * 3 - 20, x, rnd.choice([None, 1, 2, 2, 2])))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("width", [1, 3, 16])
@pytest.mark.parametrize("largest", [1, 40, 10**6, 2**45])
def test_nearest_is_exact_with_ties(width, largest):
    rnd = np.random.default_rng(width)
    for n, m in ((0, 3), (1, 1), (300, 7), (400, 256)):
        parts = rnd.integers(-largest, largest + 1, (n, width)).astype(np.float64)
        entries = [tuple(e) for e in rnd.integers(-largest, largest + 1, (m, width)).tolist()]
        entries[-1] = entries[0]
        index, best = v.nearest(parts, entries)
        wanted = [slow_nearest([int(x) for x in p], entries) for p in parts.tolist()]
        assert [(int(i), int(b)) for i, b in zip(index, best, strict=True)] == wanted


def test_search_leaves_far_entries_out(monkeypatch):
    looked = []
    look = v._look
    monkeypatch.setattr(v, "_look", lambda *a: (looked.append(len(a[5]) * (a[6].stop - a[6].start)), look(*a)))
    parts = np.repeat(np.arange(4096.0)[:, None], 4, axis=1)
    v.nearest(parts, [(x, x, x, x) for x in range(0, 4096, 16)])
    assert sum(looked) < 4096 * 256 / 3


def test_whole_query_against_brute_force(spark):
    rows = made(1, 700)
    odd = [(5000, None, 1), (-900, [1.0, None] * 4, 2), (-901, [float("nan")] * 8, 2), (-902, [float("-inf")] * 8, 1)]
    odd += [(6000, [0.5] * 7, 1), (6001, [], 1), (None, [0.25] * 8, None), (3, [0.125] * 8, 2), (3, [0.125] * 8, 2)]
    frame = spark.createDataFrame(rows + odd, SCHEMA).repartition(5)
    clashing = frame.withColumns({"code": F.lit(1), "error": F.lit("e"), "of": F.lit(2), "_v": F.lit(3)})
    found = sorted((tuple(r) for r in v.op11_vector_codes(clashing).collect()), key=repr)
    assert found == sorted(brute(rows + odd), key=repr)


def test_sql(spark, sql, result):
    rows = made(2, 500) + [(9000, [0.5] * 8, 2), (9001, [-0.0001] * 8, None), (-500, [None] * 8, 1)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    content = [(i, x, None if label is None else label) for i, x, label in rows]
    assert result(v.op11_vector_codes(frame)) == sql(OP11, [], embeddings=("vec_id bigint, embedding float[], label int", content))


@pytest.mark.parametrize("rows", [[], [(1, None, 2)], [(1, [], 2), (2, [], None)], [(4, [1.5] * 6, 0), (4, [1.5] * 6, 0)]])
def test_few_rows(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    assert sorted(tuple(r) for r in v.op11_vector_codes(frame).collect()) == brute(rows)


def test_huge_components_stay_exact(spark):
    rows = [(i, [float(np.float32(x)) for x in (i, 3e38, -1e30, 0.3 * i, 2.0**60, -(2.0**45), 1, i % 5)], 1) for i in range(40)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    books = v.train(frame, entries=7)
    wanted = brute(rows, entries=7)
    assert books.digest() == wanted[0][4]
    assert sorted(tuple(r) for r in v.encode(frame, books).select("vec_id", "code").collect()) == [w[:2] for w in wanted]


def test_codes_stand_for_near_vectors(spark):
    rows = made(4, 300)
    frame = spark.createDataFrame(rows, SCHEMA)
    books = v.train(frame, entries=64)
    decoded = {r["vec_id"]: r["decoded"] for r in v.reconstructed(v.encode(frame, books), books).collect()}
    errors = {r["vec_id"]: r["error"] for r in v.encode(frame, books).collect()}
    for i, x, _ in rows:
        whole = [floor(Fraction(a) * 1024) for a in x]
        assert sum((a - round(b * 1024)) ** 2 for a, b in zip(whole, decoded[i], strict=True)) == errors[i]


def test_partitionings_agree(spark):
    frame = spark.createDataFrame(made(5, 400), SCHEMA)
    digests = {v.train(frame.repartition(n), rounds=3).digest() for n in (1, 4, 9)}
    assert len(digests) == 1
