"""Token ids of whole texts by the tokenizers library, with ids kept per pre-token."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tripmart.llm.bpe import _byte_letters

#: Pre-tokens kept in each of two generations.
KEPT_PIECES = 400_000
#: Longer pre-tokens aren't kept.
LONGEST_KEPT = 64

# Letters, digits and white space among the characters below, which no normal form changes and whose lower
# case is one of them.
_LETTER = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f\u0400-\u0481\u048a-\u04ff"
_DIGIT = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
_BLANK = "\t-\r \u0085\u00a0"
_RARE = re.compile(
    "[^\x00-\u012f\u0131-\u017f\u0400-\u0481\u048a-\u04ff\u2010-\u2027\u2030-\u205e\u20a0-\u20bf]"
)

# The patterns of pre-tokens of the usual byte-level vocabularies, as texts of these characters have them.
_BYTES = re.compile(
    rf" ?[{_LETTER}]+|'(?:[stmd]|re|ve|ll)| ?[{_DIGIT}]+| ?[^{_LETTER}{_DIGIT}{_BLANK}]+|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+"
)
_WORDS_GIVEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORDS = re.compile(rf"[{_LETTER}]+|'(?:[stmd]|re|ve|ll)|[{_DIGIT}]|[^{_LETTER}{_DIGIT}{_BLANK}]+")

# What Python takes for white space and the tokenizers' patterns don't.
_SEPARATORS = frozenset("\x1c\x1d\x1e\x1f")

# Tasks are what runs side by side; more threads in each would only get in each other's way.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


def _cuts_at_spaces(config: dict) -> bool:
    """Whether a single space between two other characters always begins a new pre-token.

    So it is when words are split by the usual pattern of letters, digits and signs in which a
    space can only come first, and also when white space is dropped altogether.
    """
    pre = config.get("pre_tokenizer") or {}
    normalizers = (config.get("normalizer") or {}).get("normalizers", [])
    if pre.get("type") == "ByteLevel":
        return bool(pre.get("use_regex")) and not pre.get("add_prefix_space") and not config.get("normalizer")
    if pre.get("type") == "Sequence":
        first, *rest = pre["pretokenizers"]
        return (
            first.get("type") == "Split"
            and first.get("behavior") == "Removed"
            and bool(first.get("invert"))
            and "\\s" in str(first.get("pattern"))
            and all(x.get("type") == "ByteLevel" and not x.get("use_regex") for x in rest)
            and {x.get("type") for x in normalizers} <= {"NFC", "Replace", "Lowercase"}
        )
    return False


def _pattern(config: dict) -> re.Pattern | None:
    """How texts without rare characters fall into pre-tokens, for vocabularies that are cut at spaces."""
    pre = config["pre_tokenizer"]
    if pre["type"] == "ByteLevel":
        return _BYTES
    first, *rest = pre["pretokenizers"]
    same = first.get("pattern") == {"Regex": _WORDS_GIVEN} and [x.get("add_prefix_space") for x in rest] == [False]
    changes = [x for x in (config.get("normalizer") or {}).get("normalizers", []) if x.get("type") == "Replace"]
    plain = all(x.get("pattern") == {"Regex": r"\s+"} and x.get("content") == " " for x in changes)
    return _WORDS if same and plain else None


class _Known(dict):
    """Ids of pre-tokens, found when first asked for.

    The generation before is kept beside, so that pre-tokens in use outlive those that aren't.
    """

    def __init__(self, find: Callable[[str], bytes], older: dict[str, bytes]):
        super().__init__()
        self.find, self.older = find, older

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.find(piece)
        if len(piece) <= LONGEST_KEPT:
            self[piece] = ids
        return ids


class Encoder:
    """Ids of texts, as little-endian 32-bit bytes.

    A text is cut into pre-tokens and their ids are joined, which gives the library's ids for the whole
    text; most pre-tokens repeat, so few are encoded anew. Texts with rare characters are cut before each
    single space first, and what holds such a character isn't cut further. Of these, texts with longer runs of
    white space (where a cut could matter) are encoded whole, and so are all texts that hold an added token of
    the vocabulary, which the library cuts out first.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        # Some are looked for in the text as it is, some in the normalised one.
        self.added = tuple({form for x in config.get("added_tokens", []) for form in (x["content"], x["content"].lower())})
        self.by_piece = _cuts_at_spaces(config)
        normalizers = (config.get("normalizer") or {}).get("normalizers", [])
        self.folds = any(x.get("type") == "Lowercase" for x in normalizers)
        # White space is dropped, so that a text may be cut at any of it.
        self.drops_blanks = self.by_piece and config["pre_tokenizer"]["type"] == "Sequence"
        self.pattern = _pattern(config) if self.by_piece else None
        self.model = self.tokenizer.model
        self.letters = {byte: letter for letter, byte in _byte_letters().items()}
        self.known = _Known(self._ids, {})

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def _ids(self, piece: str) -> bytes:
        """Ids of a pre-token, or of a piece that isn't cut further."""
        if self.pattern is None or len(piece) > LONGEST_KEPT or _RARE.search(piece):
            return self._whole([piece])[0]
        letters = piece.encode().decode("latin-1").translate(self.letters)
        return array("I", [x.id for x in self.model.tokenize(letters)]).tobytes()

    def _cut(self, text: str) -> list[str] | None:
        """The text's pre-tokens, as far as it is cut; ``None`` if the library has to see all of it."""
        low = text.lower() if self.folds else text
        if any(x in text or x in low for x in self.added):
            return None
        if self.pattern is not None and not _RARE.search(text):
            return self.pattern.findall(low)
        if self.drops_blanks:
            if not _SEPARATORS.isdisjoint(text):
                return None
            head, pieces = "", text.split()
        else:
            head, *pieces = text.split(" ")
        if not all(p and not p[0].isspace() and p[0].isprintable() for p in pieces):
            return None
        out: list[str] = []
        for p in (head, *(f" {p}" for p in pieces)):
            if self.pattern is None or _RARE.search(p):
                out.append(p)
            else:
                out += self.pattern.findall(p.lower() if self.folds else p)
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; null is empty."""
        texts = ["" if t is None else t for t in texts]
        if not self.by_piece:
            return self._whole(texts)
        out: list[bytes] = []
        for at in range(0, len(texts), 256):
            out += self._some(texts[at : at + 256])
        return out

    def _some(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        whole = []
        for i, text in enumerate(texts):
            pieces = self._cut(text)
            if pieces is None:
                whole.append(i)
                out.append(b"")
                continue
            out.append(b"".join(map(self.known.__getitem__, pieces)))
            if len(self.known) > KEPT_PIECES:
                self.known.older = {}
                self.known = _Known(self._ids, self.known)
        for i, x in zip(whole, self._whole([texts[i] for i in whole]) if whole else [], strict=True):
            out[i] = x
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per file and worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def file_of(name: str) -> str:
    return public_tokenizers.path(name)


def ids_of(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype="<u4")
