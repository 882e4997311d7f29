from __future__ import annotations

import io
import json
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import corpus
from tokenizers import Tokenizer

from tripmart.llm import binary_records as b
from tripmart.llm import packing as p
from tripmart.llm.tokens import Encoder, file_of

BYTE, WORD = file_of("byte_bpe_50k.json"), file_of("word_bpe_49k.json")
ODD = [
    "", " ", "  ", "a  b", " a", "a ", "a \nb", "a\n b", "a\n\n b \n", "\t x", "don't 's 'll  ''s x's", "x  y   z",
    "<|endoftext|> a<|startoftext|> b", "end <|endoftext|> next", "<|EndOfText|> x", "<|endoftext", "a  <|startoftext|>  b", "\x1c a \x1d b", "é ́a é x ́", "İstanbul ΑΣ ΣΑΣ. I", "123 4 ٣ ½ ²",
    "᠎ a ᠎b", "日本 語", "​ x ﻿y", "a\r\n b \x85 c", "Straße! naïve, ﬁne; ª º µ", "I ii", None,
]


def library(path, texts):
    # As the file stands: no flag is set, added tokens in texts are found.
    t = Tokenizer.from_file(path)
    return [x.ids for x in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_ids_are_the_library_s(path, monkeypatch):
    rnd = random.Random(1)
    letters = [*" \n\t ab'sé1!. İ,*²ßÉ", "'s", "'ll", "  ", "the", "The", "<|endoftext|>", "<|StartOfText|>", "<|"]
    texts = ODD + ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 25))) for _ in range(3000)]
    texts += [t for _, t in corpus(1)]
    monkeypatch.setattr("tripmart.llm.tokens.KEPT_PIECES", 500)
    codec = Encoder(path)
    assert codec.by_piece
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(texts)] == library(path, texts)


class NotAsked:
    """Stands for the library where all that a text needs is known."""

    def __getattr__(self, name):
        raise AssertionError(f"the library was asked: {name}")


def known_parts_aren_t_encoded_anew(path):
    words, signs = ["Alpha", "beta", "gamma", "été"], ["", ".", ",", "!!", "%%%", "***"]
    codec = Encoder(path)
    codec.encode([f"{w} {w.lower()} {w}\n{w}\n{w.lower()}{x}\n{w}'s{x} 1{x}" for w in words for x in signs] + ["a  b-a", "A1"])
    fresh = [f"{v}{x} {w}{y}  {v.lower()}\n{w}{x}" for v in words for w in words for x in signs for y in signs]
    fresh += [f"a {v}-{w}1{x}" for v in words for w in words for x in signs]
    codec.tokenizer = codec.model = NotAsked()
    assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(fresh)] == library(path, fresh)


def any_characters_give_the_library_s_ids(path):
    rnd = random.Random(3)
    plain = [chr(c) for c in (*range(0x250), *range(0x370, 0x530), *range(0x2000, 0x20D0))]
    others = [*" \n\t aAs'dlr1.,!", "\x85", "\xa0", "\u3000", "漢", "\u0301", "Σ", "İ", "'s", " 's", "  "]
    texts = [f"{a}{c}{b}" for c in plain for a, b in (("", ""), ("a", "A"), (" ", " "), ("x ", "\n"), ("1", "'s"), (".", "!"))]
    texts += ["".join(rnd.choice(plain if rnd.random() < 0.3 else others) for _ in range(rnd.randint(1, 20))) for _ in range(5000)]
    texts += ["x" * 200 + " " + "y" * 200, " " * 200 + "a", "." * 100]
    codec = Encoder(path)
    assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(texts)] == library(path, texts)


def test_byte_level_parts_are_encoded_once():
    known_parts_aren_t_encoded_anew(BYTE)


def test_byte_level_ids_of_any_characters():
    any_characters_give_the_library_s_ids(BYTE)


def test_word_parts_are_encoded_once():
    known_parts_aren_t_encoded_anew(WORD)


def test_word_ids_of_any_characters():
    any_characters_give_the_library_s_ids(WORD)


def test_another_pattern_is_cut_at_spaces_only(tmp_path):
    with open(WORD, encoding="utf-8") as f:
        config = json.load(f)
    config["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]+"
    path = tmp_path / "other.json"
    path.write_text(json.dumps(config), encoding="utf-8")
    codec = Encoder(str(path))
    texts = [*ODD, "abc1 1a's 12"]
    assert codec.by_piece and codec.pattern is None
    assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(texts)] == library(str(path), texts)


@pytest.fixture(scope="module")
def rows():
    found = corpus(2, 60) + [(30_000 + i, t) for i, t in enumerate(ODD)] + [(-4, "negative"), (40_000, "long " * 9000)]
    return found


def test_records_read_back(frame, rows):
    docs = frame(rows).withColumns({"file": F.lit(1), "start": F.lit(2), "_extra": F.lit(3)})
    found = {r["doc_id"]: tuple(r)[1:] for r in b.op4_binary_records(docs).collect()}
    start = 0
    for (doc_id, _), ids in sorted(zip(rows, library(BYTE, [t for _, t in rows]), strict=True)):
        ids = np.array([*ids, 2], dtype="<u4")
        assert found[doc_id] == (start, len(ids), zlib.crc32(ids.tobytes())), doc_id
        start += len(ids)
    assert len(found) == len(rows)


@pytest.mark.parametrize("wide", [False, True])
def test_shuffled_reads_through_the_index(frame, rows, wide):
    manifest = b.write_records(frame(rows), BYTE, 2, files=3, wide=wide)
    index = b.read_index(manifest)
    fetched = b.fetch_records(index.orderBy(F.xxhash64("doc_id")))
    wanted = {i: [*ids, 2] for (i, _), ids in zip(rows, library(BYTE, [t for _, t in rows]), strict=True)}
    assert {r["doc_id"]: r["ids"] for r in fetched.collect()} == wanted
    assert manifest.agg(F.sum("n_records")).first()[0] == len(rows)


def test_null_ids_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(3, "b"), (None, "x"), (3, "a"), (1, None), (3, "a")], "doc_id long, text string")
    rows = [tuple(r)[:3] for r in b.op4_binary_records(docs).orderBy("start").collect()]
    assert rows == [(None, 0, 2), (1, 2, 1), (3, 3, 2), (3, 5, 2), (3, 7, 2)]
    assert b.op4_binary_records(docs.limit(0)).collect() == []


def test_damage_is_found():
    record = b.frame(b"payload of a record")
    assert b.unframe(io.BytesIO(record)) == b"payload of a record"
    assert b.unframe(io.BytesIO(b"")) is None
    for k in range(len(record)):
        broken = bytearray(record)
        broken[k] ^= 4
        with pytest.raises(b.DamagedRecord):
            b.unframe(io.BytesIO(bytes(broken)))
    with pytest.raises(b.DamagedRecord):
        b.unframe(io.BytesIO(record[:-1]))


def check_packing(found, wanted, capacity):
    """Pieces are the documents' ids; sequences are gapless and within the capacity."""
    pieces = {}
    for r in found:
        pieces.setdefault(r["doc_id"], []).append(r)
    assert set(pieces) == set(wanted)
    for doc_id, parts in pieces.items():
        ids = np.array(wanted[doc_id], dtype="<u4")
        assert [r["piece"] for r in sorted(parts, key=lambda r: r["piece"])] == list(range(-(-len(ids) // capacity)))
        for r in parts:
            part = ids[r["piece"] * capacity :][:capacity]
            assert (r["start"], r["length"]) == (r["piece"] * capacity, len(part))
            assert r["ids_crc32"] == zlib.crc32(part.tobytes())
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing(frame, rows):
    wanted = {i: [*ids, 1] for (i, _), ids in zip(rows, library(WORD, [t for _, t in rows]), strict=True)}
    used = check_packing(p.op5_best_fit_packing(frame(rows)).collect(), wanted, 4096)
    assert used == -(-sum(map(len, wanted.values())) // 4096)


def test_packed_sequences_hold_the_ids(frame, rows, spark):
    from tripmart.workspace import written

    parts = written(spark, p.pieces(frame(rows), WORD, 1, 256, with_ids=True), "p").withColumn("number", F.lit("x"))
    placed = p.place(parts, ["doc_id", "piece"], capacity=256)
    wanted = {i: [*ids, 1] for (i, _), ids in zip(rows, library(WORD, [t for _, t in rows]), strict=True)}
    for r in p.sequences(placed).collect():
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        for part in r["parts"]:
            whole = wanted[part["doc_id"]][256 * part["piece"] :][:256]
            assert ids[part["offset"] : part["offset"] + part["length"]] == whole


def test_packing_nulls_copies_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b")] * 5 + [(None, None), (2, None)], "doc_id long, text string")
    found = p.pack_documents(docs, capacity=4).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in found) == [(0, 1), *[(1, 3)] * 5, (2, 1)]
    assert len({r["sequence_id"] for r in found}) == 5
    assert p.op5_best_fit_packing(docs.limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_patterns_use_every_piece_once(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([7, 50, 300])
    counts = {x: rnd.randint(1, 40) for x in rnd.sample(range(1, capacity + 1), rnd.randint(1, capacity))}
    chosen = p.patterns(counts, capacity)
    used = {}
    for pattern, times in chosen:
        assert sum(pattern) <= capacity and times > 0
        for x in pattern:
            used[x] = used.get(x, 0) + times
    assert used == counts
    times = p.plan({k: v * 10**9 for k, v in counts.items()}, capacity)
    assert times.sequences <= 1.2 * sum(k * v for k, v in counts.items()) * 10**9 / capacity + max(counts) * 10**9


def test_exact_complements():
    assert p.patterns({10: 1}, 10) == [((10,), 1)]
    assert p.patterns({6: 2, 4: 2}, 10) == [((6, 4), 2)]
    assert p.patterns({5: 1, 3: 1, 2: 1}, 10) == [((5, 3, 2), 1)]
    assert p.patterns({4: 1, 3: 1, 2: 1, 1: 1}, 10) == [((4, 3, 2, 1), 1)]
    assert p.patterns({5: 3}, 10) == [((5, 5), 1), ((5,), 1)]
