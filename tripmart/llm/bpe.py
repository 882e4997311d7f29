"""Byte-level BPE as a streaming transducer with bounded lookahead, and its inverse.

A text comes in chunks. Added tokens are cut out first; what is between them falls into pre-tokens by
the usual pattern of contractions, letters, digits, signs and white space. A pre-token is closed as
soon as three characters from its start and one after its end are known, for no rule of the pattern
looks further. Closed pre-tokens become ids; the open end is held.

An open pre-token may be as long as it likes: from a certain length on, its bytes are merged in a window and
the tokens that no continuation can change are emitted, so that never more than a chunk and a window are
held. How far a continuation reaches is computed from the merge list (``lookahead``): it changes the
token that begins at a place only by a merge of a left part ``a`` there with a right part ``b`` that a
continuation has changed before, by an earlier rule, at ``b``'s own begin, where the left part of that rule is
``b`` or what ``b`` grew from at its left edge. The longest such chain of rules of rising rank bounds the reach
in bytes. This holds for lists in which the parts of each rule are bytes or results of earlier
rules, which is checked. What follows a token's end has the same tokens as if the text began there, so the window
goes on from the last token emitted.

The ids of closed pre-tokens are kept per worker, in two generations of bounded size. New ones of many
texts are merged together, a round of array operations for the next rule of each.

Decoding looks up the bytes of each id and turns them into text by a state machine over bytes that
holds an unfinished character (three bytes at most) between chunks, and writes U+FFFD for each longest
beginning of a character that breaks off.

Null texts are empty and have no ids. Repeated rows and null document ids are encoded each; an empty table
gives an empty result; columns other than the id and the text aren't read.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from tripmart.llm.common import chunks

#: Characters a transducer takes at a time.
CHUNK_CHARS = 1 << 16
#: Bytes of an open pre-token that are merged at a time, beyond the lookahead.
STRETCH_BYTES = 1024
#: Pre-tokens kept in a generation of a worker's memory.
KEPT = 200_000
#: Longer pre-tokens aren't kept.
LONGEST_KEPT = 64
#: Texts are encoded together until they have so many characters.
GROUP_CHARS = 1 << 20

_NONE = np.iinfo(np.int64).max

_BLANK = r"\p{White_Space}"
_BLANKS = 3


def _patterns(letter: str, digit: str) -> tuple[regex.Pattern, tuple[regex.Pattern, ...]]:
    """The pattern of pre-tokens, and what a run of each of its kinds goes on with."""
    sign = f"[^{_BLANK}{letter}{digit}]"
    # The usual pattern of byte-level vocabularies.
    whole = f"'(?:[stmd]|re|ve|ll)| ?{letter}++| ?{digit}++| ?{sign}++|{_BLANK}+(?!{_BLANK.replace('p', 'P')})|{_BLANK}+"
    kinds = (letter, digit, sign, _BLANK)
    return regex.compile(whole, regex.V1), tuple(regex.compile(f"{k}*+", regex.V1) for k in kinds)


_USUAL = _patterns(r"\p{L}", r"\p{N}")


@cache
def _newer() -> frozenset[str]:
    """Letters and digits of ``regex``'s edition of Unicode that the tokenizers library, of an older one, has as signs."""
    characters = "".join(chr(c) for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000)
    unknown = [c for c in regex.findall(r"[\p{L}\p{N}]", characters) if unicodedata.category(c) == "Cn"]
    cut = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    return frozenset(c for c in unknown if len(cut(f"!{c}")) == 1)


@cache
def _careful() -> tuple[regex.Pattern, tuple[regex.Pattern, ...]]:
    newer = "".join(sorted(_newer()))
    return _patterns(rf"[\p{{L}}--[{newer}]]", rf"[\p{{N}}--[{newer}]]")


def patterns_for(text: str) -> tuple[regex.Pattern, tuple[regex.Pattern, ...]]:
    """The patterns to use, the fast ones wherever the editions of Unicode agree on the text."""
    return _USUAL if text.isascii() or _newer().isdisjoint(text) else _careful()


#: No rule of the pattern looks at more characters from a pre-token's start, unless it goes on after them.
_LOOK = 3


def _byte_letters() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: themselves if they can be seen, else those
    from U+0100 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


class Merges:
    """The rules of a byte-level BPE: ids of bytes, and for pairs of ids the rank and the id they merge to."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        model, pre = config["model"], config.get("pre_tokenizer") or {}
        plain = (
            model.get("type") == "BPE"
            and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space")
            and not config.get("normalizer")
            and not any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
            and not model.get("ignore_merges")
        )
        if not plain:
            raise ValueError(f"not a plain byte-level BPE: {path}")
        letters, vocabulary = _byte_letters(), model["vocab"]
        self.size = max([*vocabulary.values(), *(x["id"] for x in config.get("added_tokens", []))]) + 1
        self.bytes: list[bytes] = [b""] * self.size
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(letters[c] for c in token)
        self.byte_ids = np.array([vocabulary[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])], dtype=np.int64)

        pairs = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        left = np.array([vocabulary[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], dtype=np.int64)
        made = np.array([vocabulary[a + b] for a, b in pairs], dtype=np.int64)
        self._check(left.tolist(), right.tolist(), made.tolist())
        keys = left * self.size + right
        self._rank = np.argsort(keys, kind="stable")
        self._keys, self._made = keys[self._rank], made
        self.lookahead = self._reach(left.tolist(), right.tolist(), made.tolist())

        self.added: dict[str, int] = {}
        for x in config.get("added_tokens", []):
            if x.get("single_word") or x.get("lstrip") or x.get("rstrip"):
                raise ValueError(f"an added token takes what is beside it: {x['content']!r}")
            self.added[x["content"]] = x["id"]
            self.bytes[x["id"]] = x["content"].encode()

    def _check(self, left: list[int], right: list[int], made: list[int]) -> None:
        known = set(self.byte_ids.tolist())
        for a, b, c in zip(left, right, made, strict=True):
            if a not in known or b not in known or c in known:
                raise ValueError("a merge uses a token that no earlier merge makes, or makes one anew")
            known.add(c)

    def _reach(self, left: list[int], right: list[int], made: list[int]) -> int:
        """The largest number of bytes before the end of the known text whose tokens more text can change."""
        edge = dict(zip(made, left, strict=True))
        reach: dict[int, int] = {}
        for a, b in zip(left, right, strict=True):
            before, at = reach.get(b, 0), b
            while at in edge:
                at = edge[at]
                before = max(before, reach.get(at, 0))
            reach[a] = max(reach.get(a, 0), len(self.bytes[a]) + before)
        return max(reach.values(), default=0) + 1

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[at] == keys, self._rank[at], _NONE) if len(self._keys) else np.full(len(a), _NONE)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece as little-endian 32-bit bytes, all pieces merged together.

        In each round every piece that isn't done applies its lowest rule wherever it can, from the left; what a
        rule makes is part of later rules only.
        """
        out = [b""] * len(pieces)
        owner = np.array([k for k, p in enumerate(pieces) if p], dtype=np.int64)
        sizes = np.array([len(p) for p in pieces if p], dtype=np.int64)
        tokens = self.byte_ids[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        ranks = np.full(len(tokens), _NONE)
        ranks[:-1] = self._ranks(tokens[:-1], tokens[1:])
        ranks[np.cumsum(sizes) - 1] = _NONE
        while len(owner):
            begins = np.cumsum(sizes) - sizes
            lowest = np.minimum.reduceat(ranks, begins)
            done = lowest == _NONE
            if done.any():
                of_done = np.repeat(done, sizes)
                data = tokens[of_done].astype("<u4").tobytes()
                ends = 4 * np.cumsum(sizes[done])
                for k, x, y in zip(owner[done].tolist(), (ends - 4 * sizes[done]).tolist(), ends.tolist(), strict=True):
                    out[k] = data[x:y]
                tokens, ranks = tokens[~of_done], ranks[~of_done]
                owner, sizes, lowest = owner[~done], sizes[~done], lowest[~done]
                if not len(owner):
                    break
                begins = np.cumsum(sizes) - sizes
            hits = np.flatnonzero(ranks == np.repeat(lowest, sizes))
            # Of places in a row, which overlap, every other one, from the left.
            index = np.arange(len(hits))
            row = np.maximum.accumulate(np.where(np.diff(hits, prepend=-2) > 1, index, 0))
            at = hits[(index - row) % 2 == 0]
            piece = np.searchsorted(begins, at, side="right") - 1
            tokens[at] = self._made[lowest[piece]]
            left = np.ones(len(tokens), dtype=bool)
            left[at + 1] = False
            tokens, ranks = tokens[left], ranks[left]
            sizes = sizes - np.bincount(piece, minlength=len(sizes))
            at = at - np.arange(len(at))
            ends = np.cumsum(sizes)
            changed = np.concatenate((at, at[at > (ends - sizes)[piece]] - 1))
            ranks[changed] = _NONE
            changed = changed[changed + 1 < ends[np.searchsorted(ends, changed, side="right")]]
            ranks[changed] = self._ranks(tokens[changed], tokens[changed + 1])
        return out

    def stable(self, data: bytes) -> tuple[bytes, int]:
        """Ids of the open piece that begins with ``data`` as far as nothing after it can change them, and how many
        bytes they have."""
        ids = self.merge([data])[0]
        ends = np.cumsum([len(self.bytes[i]) for i in np.frombuffer(ids, dtype="<u4").tolist()])
        n = int(np.searchsorted(ends, len(data) - self.lookahead, side="right"))
        return ids[: 4 * n], int(ends[n - 1]) if n else 0


class Cutter:
    """Cuts a text that comes in chunks into pieces whose tokens are settled: strings are whole pre-tokens, bytes are
    stretches of long ones between two token ends, numbers are ids of added tokens."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.held = ""
        self.run = b""
        self.kind: int | None = None
        added = sorted(merges.added, key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.longest = max(map(len, added), default=0)
        self.tail = ""

    def feed(self, text: str, last: bool = False) -> list[str | bytes | int]:
        """Pieces settled by the next chunk; ``last`` says that the text ends with it."""
        if not self.added:
            return self._plain(text, last)
        text, out, at = self.tail + text, [], 0
        held = 0 if last else self._begun(text)
        if any(x in text for x in self.merges.added):
            for m in self.added.finditer(text):
                if m.end() > len(text) - held and self._begun(text[m.start() :]) == len(text) - m.start():
                    break  # it may go on to a longer one
                out += self._plain(text[at : m.start()], True)
                out.append(self.merges.added[m.group()])
                at = m.end()
        end = len(text) if last else len(text) - self._begun(text[at:])
        self.tail = text[end:]
        return out + self._plain(text[at:end], last)

    def _begun(self, text: str) -> int:
        """Length of the longest end of a text that an added token goes on from."""
        for n in range(min(self.longest - 1, len(text)), 0, -1):
            if any(len(x) > n and x.startswith(text[-n:]) for x in self.merges.added):
                return n
        return 0

    def _plain(self, text: str, last: bool) -> list[str | bytes]:
        out: list[str | bytes] = []
        text, self.held = self.held + text, ""
        if self.kind is not None:
            text = self._go_on(text, last, out)
            if self.kind is not None:
                return out
        pattern, runs = patterns_for(text)
        pieces = pattern.findall(text)
        if last:
            return out + pieces
        begin = end = len(text)
        while pieces and (end == len(text) or end - len(pieces[-1]) + _LOOK > len(text)):
            end -= len(pieces.pop())
            begin = end
        self.held = text[begin:]
        if len(self.held) > self.merges.lookahead + STRETCH_BYTES:
            self.kind = next(k for k, r in enumerate(runs) if r.fullmatch(self.held, 1))
            text, self.held = self.held, ""
            self._go_on(text, False, pieces)
        return out + pieces

    def _go_on(self, text: str, last: bool, out: list[str | bytes]) -> str:
        """Take what a long pre-token goes on with; what comes after it, if it has ended."""
        begins = not self.run
        _, runs = patterns_for(text)
        end = runs[self.kind].match(text, 1 if begins and text else 0).end()
        ended = end < len(text)
        if self.kind == _BLANKS and (ended or not last):
            end = max(end - 1, 0)  # the last white space before another character is a piece by itself
        self.run += text[:end].encode("utf-8", "surrogatepass")
        window = self.merges.lookahead + STRETCH_BYTES
        while len(self.run) > window:
            _, size = self.merges.stable(self.run[:window])
            out.append(self.run[:size])
            self.run = self.run[size:]
        if ended or last:
            out.append(self.run)
            self.run, self.kind = b"", None
            return text[end:]
        self.held = text[end:]
        return ""


class Transducer:
    """Ids of texts; remembers the ids of pre-tokens in two generations, so that those in use outlive the others."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.young: dict[str | bytes | int, bytes] = {}
        self.old: dict[str | bytes | int, bytes] = {}

    def _learn(self, wanted: set[str | bytes | int]) -> None:
        """Take up ids of pieces that the young generation lacks, from the old one or anew."""
        old, known = self.old, self.young
        new = []
        for p in wanted:
            ids = old.get(p)
            if ids is not None:
                known[p] = ids
            elif isinstance(p, int):
                known[p] = p.to_bytes(4, "little")
            else:
                new.append(p)
        data = [p if isinstance(p, bytes) else p.encode("utf-8", "surrogatepass") for p in new]
        known.update(zip(new, self.merges.merge(data), strict=True))

    def ids(self, pieces: list[list[str | bytes | int]]) -> list[bytes]:
        """The ids of each text's pieces, joined."""
        known = self.young
        new = set().union(*pieces).difference(known)
        self._learn(new)
        out = [b"".join(map(known.__getitem__, some)) for some in pieces]
        for p in new:
            if not isinstance(p, int) and len(p) > LONGEST_KEPT:
                del known[p]
        if len(known) > KEPT:
            self.old, self.young = known, {}
        return out

    def stream(self, text: Iterable[str]) -> Iterator[bytes]:
        """Ids of one text that comes in chunks, as they settle; holds a chunk and a window at most."""
        cutter = Cutter(self.merges)
        for chunk in text:
            yield self.ids([cutter.feed(chunk)])[0]
        yield self.ids([cutter.feed("", True)])[0]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, in little-endian 32-bit bytes."""
        out: list[bytes] = []
        texts = ["" if t is None else t for t in texts]
        for a, b in chunks(list(map(len, texts)), GROUP_CHARS):
            if b - a == 1 and len(texts[a]) > CHUNK_CHARS:
                parts = (texts[a][k : k + CHUNK_CHARS] for k in range(0, len(texts[a]), CHUNK_CHARS))
                out.append(b"".join(self.stream(parts)))
            else:
                cutter = Cutter(self.merges)
                out += self.ids([cutter.feed(t, True) for t in texts[a:b]])
        return out


# By first byte of a character, its length and the range of its second byte.
_SHAPES = [
    (range(0x00, 0x80), 1, (0, 0)),
    (range(0xC2, 0xE0), 2, (0x80, 0xBF)),
    (range(0xE0, 0xE1), 3, (0xA0, 0xBF)),
    (range(0xE1, 0xED), 3, (0x80, 0xBF)),
    (range(0xED, 0xEE), 3, (0x80, 0x9F)),
    (range(0xEE, 0xF0), 3, (0x80, 0xBF)),
    (range(0xF0, 0xF1), 4, (0x90, 0xBF)),
    (range(0xF1, 0xF4), 4, (0x80, 0xBF)),
    (range(0xF4, 0xF5), 4, (0x80, 0x8F)),
]
_BEGINS = {b: (length, *second) for firsts, length, second in _SHAPES for b in firsts}
_BROKEN = "�"


class Decoder:
    """Text of ids that come in parts. The state is the unfinished character's bytes."""

    def __init__(self, merges: Merges):
        self.bytes = merges.bytes
        self.begun = b""

    def feed(self, ids: bytes, last: bool = False) -> str:
        """The text that more ids complete; ids that the vocabulary lacks give nothing."""
        vocabulary, size = self.bytes, len(self.bytes)
        numbers = np.frombuffer(ids, dtype="<u4")
        if len(numbers) and numbers.max() >= size:
            numbers = numbers[numbers < size]
        data = self.begun + b"".join(map(vocabulary.__getitem__, numbers.tolist()))
        self.begun = b""
        try:
            return data.decode("utf-8")
        except UnicodeDecodeError as at:
            sound = data[: at.start].decode("utf-8")
            return sound + self._step(data[at.start :], last)

    def _step(self, data: bytes, last: bool) -> str:
        """Byte by byte from the first that isn't part of a sound character."""
        out: list[str] = []
        begun = bytearray()
        for byte in data:
            if begun:
                length, low, high = _BEGINS[begun[0]]
                if len(begun) > 1:
                    low, high = 0x80, 0xBF
                if low <= byte <= high:
                    begun.append(byte)
                    if len(begun) == length:
                        out.append(begun.decode("utf-8"))
                        begun.clear()
                    continue
                out.append(_BROKEN)
                begun.clear()
            shape = _BEGINS.get(byte)
            if shape is None:
                out.append(_BROKEN)
            elif shape[0] == 1:
                out.append(chr(byte))
            else:
                begun.append(byte)
        if last and begun:
            out.append(_BROKEN)
        elif begun:
            self.begun = bytes(begun)
        return "".join(out)


_TRANSDUCERS: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """One per file and worker process."""
    if path not in _TRANSDUCERS:
        _TRANSDUCERS[path] = Transducer(path)
    return _TRANSDUCERS[path]


def file_of(name: str) -> str:
    return public_tokenizers.path(name)


def _encoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in chunks([len(t or "") for t in texts], GROUP_CHARS):
                ids = pa.array(machine.encode(texts[a:b]), type=pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), ids], ["doc_id", "ids"])

    return run


def _decoder(path: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = transducer(path).merges
        step = 4 * CHUNK_CHARS
        for batch in batches:
            ids = batch.column(batch.num_columns - 1).to_pylist()
            for a, b in chunks([len(x or b"") for x in ids], 4 * GROUP_CHARS):
                texts = []
                for data in ids[a:b]:
                    machine, data = Decoder(merges), data or b""
                    parts = [machine.feed(data[k : k + step], k + step >= len(data)) for k in range(0, len(data), step)]
                    texts.append("".join(parts))
                columns = [c.slice(a, b - a) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, type=pa.string())], names)

    return run


def encoded(documents: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, ids``: the token ids of each text as little-endian 32-bit bytes; ``tokenizer`` is a file of the
    tokenizers library that holds a plain byte-level BPE."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_encoder(tokenizer), "doc_id long, ids binary")


def decoded(rows: DataFrame, tokenizer: str) -> DataFrame:
    """``rows`` with the ``text`` of their ``ids``, which replaces a column of that name."""
    rest = rows.drop("text")
    schema = rest.withColumn("text", F.lit("").cast("string")).schema
    names = schema.names
    kept = rest.select(*rest.columns, F.col("ids").alias("_of"))
    return kept.mapInArrow(_decoder(tokenizer, names), schema)


def op13_bpe_codec(documents: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Encode every text, decode the ids and report both by digest."""
    path = tokenizer or file_of("byte_bpe_50k.json")
    back = decoded(encoded(documents, path), path)
    return back.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
