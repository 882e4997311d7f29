from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import corpus

from tripmart.llm import ngram_join as j
from tripmart.llm.components import components
from tripmart.llm.oracles import OP9


def shingles(text, size):
    words = (text or "").encode()
    words = bytes(b + 32 if 65 <= b <= 90 else b for b in words).split()
    if 0 < len(words) < size:
        return {tuple(words)}
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, percent=85, size=4):
    sets = [(i, shingles(t, size)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (a, s) in enumerate(sets):
        for b, t in sets[:k]:
            common = len(s & t)
            if s and t and 100 * common >= percent * (len(s) + len(t) - common):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted((i, len(s), find(i)) for i, s in sets)


def found(frame_, **options):
    return sorted(tuple(r) for r in j.joined(frame_, **options).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_brute_force(frame, seed):
    rows = corpus(seed, 70, 300, 120)
    assert found(frame(rows, seed)) == brute(rows)


def test_other_shingles_and_similarity(frame):
    rows = corpus(3, 60, 300, 120)
    assert found(frame(rows), percent=80, size=5) == brute(rows, 80, 5)


def test_equal_to_sql(frame, sql, result):
    rows = corpus(4, 40)
    assert result(j.op9_ngram_join(frame(rows))) == sql(OP9, rows)


def test_borderline_pairs_of_all_sizes():
    """Any two sets within the bound share a key, whatever parts are crowded."""
    rnd = np.random.default_rng(1)
    for n in (1, 2, 5, 6, 7, 13, 31, 32, 63, 64, 100, 127, 130, 255, 300):
        for _ in range(6):
            base = rnd.integers(0, 2**63, n + n, dtype=np.uint64)
            for extra in range(n * 20 // 100 + 1):
                for lost in range(n * 20 // 100 + 1):
                    a, b = base[:n], np.concatenate([base[lost:n], base[n : n + extra]])
                    common = n - lost
                    if len(b) and 100 * common >= 85 * (n + len(b) - common):
                        every = np.concatenate([j.sketch_keys(x) for x in (a, b)])
                        crowded = np.sort(rnd.choice(np.unique(every), len(every) // 3, replace=False))
                        one, two = (j.sketch_keys(x, 85, crowded) for x in (a, b))
                        assert np.isin(one, two).any(), (n, extra, lost)


def test_sketch_bounds_the_difference():
    rnd = np.random.default_rng(2)
    for _ in range(50):
        base = rnd.integers(0, 2**63, 400, dtype=np.uint64)
        a, b = base[: rnd.integers(1, 300)], base[rnd.integers(0, 100) :]
        apart = len(np.setxor1d(a, b))
        x, y = j.short_sketch(a), j.short_sketch(b)
        assert sum(int(v).bit_count() for v in (x ^ y).view(np.uint64)) <= apart


def test_group_of_near_copies_and_chains(frame):
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    rows, text = [], list(base)
    for i in range(40):
        rows.append((i, " ".join(text)))
        text[rnd.randint(0, 119)] = f"c{i}"
    rows += [(100 + i, " ".join(base[:60] + [f"{i}x{k}" for k in range(60)])) for i in range(40)]
    assert found(frame(rows, 6)) == brute(rows)


def test_nulls_repeated_rows_clashing_columns_and_empty_table(spark, frame):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame(
        [(None, text), (7, text), (7, text), (3, text), (4, None), (5, ""), (7, "other words here now")], "doc_id long, text string"
    )
    rows = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in j.joined(docs).collect()), key=repr)
    wanted = [(None, 27, None), (7, 27, 3), (7, 27, 3), (3, 27, 3), (4, 0, 4), (5, 0, 5), (7, 1, 3)]
    assert rows == sorted(wanted, key=repr)
    assert j.joined(docs.limit(0)).collect() == []
    clash = docs.withColumns({c: F.lit(1) for c in ("key", "id", "first", "node", "root", "n", "class", "_kept_id")})
    kept = j.one_of_each(clash)
    assert kept.columns == clash.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([None, 3, 4, 5], key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rnd = random.Random(seed)
    links = [(rnd.randint(0, 60), rnd.randint(0, 60)) for _ in range(35)] + [(i, i + 1) for i in range(100, 140)]
    links += [(200, i) for i in range(201, 240)]
    root = {x: x for link in links for x in link}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    rows = {r["node"]: r["root"] for r in components(spark, spark.createDataFrame(links, "x long, y long")).collect()}
    alone = {a for a, b in links if a == b} - {x for a, b in links if a != b for x in (a, b)}
    assert rows == {x: find(x) for x in root if x not in alone}
    assert components(spark, spark.createDataFrame([], "x long, y long")).collect() == []
