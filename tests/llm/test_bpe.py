from __future__ import annotations

import json
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import corpus
from tokenizers import Tokenizer

from tripmart.llm import bpe

PATH = bpe.file_of("byte_bpe_50k.json")
LETTERS = [
    *" \n\t ab'sé1!. İ,*²ßÉ\xa0\x85\x1c日本😀　᠎​٣½", "'s", "'ll", "'re", "  ", "the", "The", "<|endoftext|>", "<|endof", "<|"
]


@pytest.fixture(scope="module")
def machine():
    return bpe.Transducer(PATH)


@pytest.fixture(scope="module")
def library():
    # As the file stands: no flag is set, added tokens in texts are found.
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(1)
    found = ["".join(rnd.choice(LETTERS) for _ in range(rnd.randint(0, 25))) for _ in range(3000)]
    return found + ["", None, "<|endoftext|>", "<|endoftext|" * 3, "a<|endoftext|><|endoftext|> b"] + [t for _, t in corpus(3)]


@pytest.fixture(scope="module")
def runs():
    """Pre-tokens of thousands of bytes, some of which the merges of the list run through."""
    rnd = random.Random(2)
    parts = ["a", "e", "ing", "aaaa", "-", "=", "the", "re", "é", "ab", "guarantee", "th"]
    found = []
    for _ in range(16):
        some = [rnd.choice(parts) for _ in range(rnd.randint(1, 6))]
        body = "".join(rnd.choice(some) for _ in range(rnd.randint(1500, 3000)))
        found.append(rnd.choice(["", " "]) + body + rnd.choice(["", " x", "'s", " \n y", "<|endoftext|>"]))
    for c in (" ", "\n", "a", "=", "*", " \n", "ÃÂ", "1", "日"):
        found += [c * n + e for n in (1399, 4001) for e in ("", " x", "x")]
    return found


def ids(library, texts):
    return [x.ids for x in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def numbers(data):
    return np.frombuffer(data, dtype="<u4").tolist()


def test_ids_are_the_library_s(machine, library, texts, runs):
    assert [numbers(x) for x in machine.encode(texts + runs)] == ids(library, texts + runs)


@pytest.mark.parametrize("size", [1, 2, 7])
def test_chunks_make_no_difference(machine, library, texts, size):
    some = [t or "" for t in texts[::4]]
    found = [b"".join(machine.stream(t[k : k + size] for k in range(0, len(t), size))) for t in some]
    assert [numbers(x) for x in found] == ids(library, some)


def test_long_pre_tokens_in_chunks(machine, library, runs):
    found = [b"".join(machine.stream(t[k : k + 333] for k in range(0, len(t), 333))) for t in runs]
    assert [numbers(x) for x in found] == ids(library, runs)


def test_memory_stays_bounded(machine):
    """What is held doesn't grow with the text, not even within one pre-token."""
    for letter in ("ab", " ", "=", "9"):
        cutter = bpe.Cutter(machine.merges)
        for _ in range(60):
            cutter.feed(letter * 500)
            assert len(cutter.held) + len(cutter.run) + len(cutter.tail) <= 3 * 1000 + machine.merges.lookahead + bpe.STRETCH_BYTES
        assert cutter.feed("", True)


def test_stable_tokens_are_those_of_every_continuation(machine):
    rnd = random.Random(4)
    merges = machine.merges
    pieces = ["a", "e", "in", "ing", "the", "aa", "--", "guarantee", "é", "ÃÂ"]
    for _ in range(15):
        some = [rnd.choice(pieces) for _ in range(rnd.randint(1, 4))]
        data = "".join(rnd.choice(some) for _ in range(900)).encode()[: merges.lookahead + 300]
        stable, size = merges.stable(data)
        assert sum(len(merges.bytes[i]) for i in numbers(stable)) == size > 0
        for _ in range(6):
            more = "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 300))).encode()
            assert merges.merge([data + more])[0].startswith(stable)


def small(tmp_path, merges, added=()):
    """A tokenizer file of the bytes and some merges."""
    letters = sorted(bpe._byte_letters())
    tokens = letters + ["".join(m) for m in merges]
    vocabulary = {t: i for i, t in enumerate(tokens)}
    with open(PATH, encoding="utf-8") as f:
        config = json.load(f)
    config["model"] |= {"vocab": vocabulary, "merges": [list(m) for m in merges]}
    config["added_tokens"] = [
        config["added_tokens"][0] | {"id": len(tokens) + k, "content": c} for k, c in enumerate(added)
    ]
    path = tmp_path / f"{zlib.crc32(repr((merges, added)).encode())}.json"
    path.write_text(json.dumps(config), encoding="utf-8")
    return str(path)


def test_reach_of_small_lists(tmp_path):
    assert bpe.Merges(small(tmp_path, [])).lookahead == 1
    assert bpe.Merges(small(tmp_path, [("a", "b")])).lookahead == 2
    # "c" decides on "bc", that on "a" + "bc".
    assert bpe.Merges(small(tmp_path, [("b", "c"), ("a", "bc")])).lookahead == 3
    # A chain has rising ranks: what "ab" changes is past when "bc" comes.
    assert bpe.Merges(small(tmp_path, [("a", "b"), ("b", "c")])).lookahead == 2


def test_random_merge_lists(tmp_path):
    rnd = random.Random(6)
    for seed in range(12):
        known, merges = ["a", "b", "c"], []
        for _ in range(25):
            pair = (rnd.choice(known), rnd.choice(known))
            if "".join(pair) not in known:
                merges.append(pair)
                known.append("".join(pair))
        path = small(tmp_path, merges, ("<x>", "<x>y", "zz") if seed % 2 else ())
        machine, library = bpe.Transducer(path), Tokenizer.from_file(path)
        some = ["".join(rnd.choice("aabbc") for _ in range(rnd.randint(0, 60))) + rnd.choice(["", "<x>yy", "<x", "zzz"]) for _ in range(60)]
        some += ["".join(rnd.choice("aabbc") for _ in range(4000))]
        assert [numbers(x) for x in machine.encode(some)] == ids(library, some)
        found = [b"".join(machine.stream(t[k : k + 3] for k in range(0, len(t), 3))) for t in some]
        assert [numbers(x) for x in found] == ids(library, some)
        data = some[-1].encode()
        stable, _ = machine.merges.stable(data[: machine.merges.lookahead + 50])
        assert machine.merges.merge([data])[0].startswith(stable)


def test_lists_that_break_the_proof_are_refused(tmp_path):
    with pytest.raises(ValueError):
        bpe.Merges(small(tmp_path, [("ab", "c"), ("a", "b")]))
    with pytest.raises(ValueError):
        bpe.Merges(bpe.file_of("word_bpe_49k.json"))


def test_every_character_is_cut_as_by_the_library(machine, library):
    """Alone, after a letter, a digit, a sign and a space: one text for each block of code points."""
    for begin in range(0, 0x30000, 0x1000):
        chars = [chr(c) for c in range(begin, begin + 0x1000) if not 0xD800 <= c < 0xE000]
        text = "".join(f"x{c}x1{c}1!{c}! {c}\n" for c in chars)
        pieces = bpe.Cutter(machine.merges).feed(text, True)
        spans = [b for _, (_, b) in library.pre_tokenizer.pre_tokenize_str(text)]
        assert np.cumsum([len(p) for p in pieces]).tolist() == spans, hex(begin)


def test_decoder_against_the_library(machine, library):
    rnd = random.Random(5)
    for _ in range(2000):
        some = [rnd.choice([rnd.randrange(256), rnd.randrange(50257)]) for _ in range(rnd.randint(0, 12))]
        data = np.array(some, dtype="<u4").tobytes()
        wanted = library.decode(some, skip_special_tokens=False)
        assert bpe.Decoder(machine.merges).feed(data, True) == wanted
        decoder = bpe.Decoder(machine.merges)
        parts = [decoder.feed(data[k : k + 4]) for k in range(0, len(data), 4)]
        assert "".join(parts) + decoder.feed(b"", True) == wanted
        assert len(decoder.begun) <= 3


def test_ids_beyond_the_vocabulary_give_nothing(machine):
    data = np.array([50256, 60000, 257], dtype="<u4").tobytes()
    assert bpe.Decoder(machine.merges).feed(data, True) == "<|endoftext|> a"


def test_query_against_the_library(frame, library, texts):
    rows = list(enumerate([*texts, "long " * 100_000, "é" * 50_000])) + [(None, "no id"), (1, "twice"), (1, "twice")]
    docs = frame(rows).withColumns({"ids": F.lit(1), "n_tokens": F.lit("x"), "_of": F.lit(2)})
    import hashlib

    wanted = []
    for (i, text), some in zip(rows, ids(library, [t for _, t in rows]), strict=True):
        back = library.decode(some, skip_special_tokens=False)
        data = np.array(some, dtype="<u4").tobytes()
        wanted.append((i, len(some), hashlib.sha256(data).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
        assert back == (text or "")
    found = [tuple(r) for r in bpe.op13_bpe_codec(docs).collect()]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    assert bpe.op13_bpe_codec(frame([])).collect() == []


def test_two_generations(machine, library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 300)
    some = [t for _, t in corpus(7, 200)]
    small_machine = bpe.Transducer(PATH)
    for _ in range(2):
        found = [x for t in range(0, len(some), 10) for x in small_machine.encode(some[t : t + 10])]
        assert [numbers(x) for x in found] == ids(library, some)
        assert len(small_machine.young) <= 300
