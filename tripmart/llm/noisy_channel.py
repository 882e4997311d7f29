"""Noisy-channel restoration of disguised words.

Observed characters are a disguise of letters: look-alike signs and digits, separators, spaces
between letters, and repetition. For each disguised word a lattice holds what every run of characters may
stand for, with the channel's log probability, and the Viterbi path under a trigram model of the
corpus' characters is the restored word. Words that can only be themselves aren't decoded. Words of letters
alone that have an alternative (doubled letters, inner hyphens or apostrophes) are decoded, and stay as
they are unless the path is likelier by more than a disguise is rare. Look-alikes without any letter have
to give a likely word. Spaces go where the model finds the letters on both sides likelier without.

The model's letters are ``LETTERS`` and the corpus' commonest others, at most ``MORE_LETTERS``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Letters that the character model always has; what has no letter there is a boundary.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿœšžłő"
# What look-alike signs may stand for.
LOOK_ALIKES = {
    "0": "ou",
    "1": "il",
    "3": "e",
    "4": "a",
    "5": "s",
    "6": "g",
    "7": "t",
    "8": "b",
    "9": "g",
    "@": "a",
    "$": "s",
    "!": "i",
    "|": "il",
    "+": "t",
    "€": "e",
    "£": "l",
}
SYMBOLS = len(LETTERS) + 1
MORE_LETTERS = 40
#: Letters under this share of a corpus' letters aren't taken.
LEAST_SHARE = 1e-6
_EDGE = ".,;:?!\"'()[]{}<>«»„“”‘’…*_-~#%&/\\^`="
_PLAIN = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]{2,})*|[^\W\d_]{2,}(?:['’-][^\W\d_]+)*")
_TWICE = re.compile(r"(.)\1")
_THRICE = re.compile(r"(.)\1\1")
# Signs in a row are decoration; two that may be letters can also be those.
_TAIL = re.compile(r"(?:([^\w\s$@+€£])\1+|([$@+€£])\2{2,})$")
_HEAD = re.compile(r"^(?:([^\w\s$@+€£])\1+|([$@+€£])\2{2,})")
SPACED = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")
# Inside a word; at its edge they are punctuation more often.
_INNER = {c: letters[0] for c, letters in LOOK_ALIKES.items() if c not in "!|+"}
_RUN = re.compile(r"(.)\1*", re.S)

#: Log probabilities of the channel.
DOUBLE_FOR_ONE, STRETCHED, LOOK_ALIKE, SEPARATOR, GAP = -2.5, -0.6, -0.9, -0.4, -0.7
#: The same of a look-alike that stands for nothing: a sign may be decoration, a digit hardly.
DROPPED, DROPPED_DIGIT = -3.0, -8.0
#: How much likelier than as it stands a word of letters has to be to count as disguised.
DISGUISED = 4.0
#: Log probabilities of a dropped space between pieces and of a kept one.
SPACE = (-0.5, 0.0)
#: The same where dropping it gives a word that matters.
SPACE_IN_KEY = (3.0, 0.0)
#: Log probability per character that look-alikes without a letter have to reach as a word.
PLAUSIBLE = -3.0


def _codes(letters: str) -> np.ndarray:
    table = np.zeros(0x110000, dtype=np.uint8)
    for i, c in enumerate(letters):
        table[ord(c)] = i + 1
    return table


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _texts(batch: pa.RecordBatch) -> Iterator[str]:
    texts = batch.column(0).to_pylist()
    for at in range(0, len(texts), 512):
        yield "  ".join(["", *(t or "" for t in texts[at : at + 512]), ""]).lower()


def _count_letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = np.zeros(0x110000, dtype=np.int64)
        for text in _texts(batch):
            some = np.bincount(_code_points(text))
            counts[: len(some)] += some
        there = np.array([c for c in np.flatnonzero(counts).tolist() if chr(c).isalpha()], dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(counts[there])], ["letter", "n"])


def corpus_letters(documents: DataFrame) -> str:
    """``LETTERS`` and the commonest other letters of all documents."""
    rows = documents.select(F.col("text").cast("string").alias("text")).mapInArrow(_count_letters, "letter long, n long")
    rows = rows.groupBy("letter").agg(F.sum("n").alias("n"))
    total = rows.agg(F.sum("n")).first()[0] or 0
    others = rows.where(~F.col("letter").isin([ord(c) for c in LETTERS])).where(F.col("n") >= LEAST_SHARE * total)
    found = others.orderBy(F.desc("n"), "letter").limit(MORE_LETTERS).collect()
    return LETTERS + "".join(sorted(chr(r["letter"]) for r in found))


def _count(letters: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Trigrams of each batch."""
        table, size = _codes(letters), len(letters) + 1
        for batch in batches:
            counts = np.zeros(size**3, dtype=np.int64)
            for text in _texts(batch):
                s = table[_code_points(text)].astype(np.int64)
                if len(s) > 2:
                    counts += np.bincount((s[:-2] * size + s[1:-1]) * size + s[2:], minlength=size**3)
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["trigram", "n"])

    return run


def character_counts(documents: DataFrame, letters: str = LETTERS) -> np.ndarray:
    """Counts of all documents' character trigrams; their number is bounded by the alphabet."""
    size = len(letters) + 1
    texts = documents.select(F.col("text").cast("string").alias("text"))
    rows = texts.mapInArrow(_count(letters), "trigram long, n long")
    counts = np.zeros(size**3, dtype=np.float64)
    for r in rows.groupBy("trigram").agg(F.sum("n").alias("n")).collect():
        counts[r["trigram"]] = r["n"]
    return counts.reshape(size, size, size)


def character_model(counts: np.ndarray, weight: float = 20.0) -> np.ndarray:
    """Log probabilities of a character after two others, smoothed by shorter contexts."""
    one = counts.sum(axis=(0, 1)) + 1
    one /= one.sum()
    pairs = counts.sum(axis=0)
    two = (pairs + weight * one) / (pairs.sum(axis=1, keepdims=True) + weight)
    three = (counts + weight * two) / (counts.sum(axis=2, keepdims=True) + weight)
    return np.log(three).astype(np.float32)


class Restorer:
    """Restored words under a character model, remembered per worker."""

    def __init__(self, model: np.ndarray, kept: int = 200_000, letters: str = LETTERS):
        self.letters, self.size = letters, len(letters) + 1
        self.number = {c: i + 1 for i, c in enumerate(letters)}
        self.table = _codes(letters)
        for c, letter in _INNER.items():
            self.table[ord(c)] = self.number[letter]
        self.scores = model.ravel()
        self.model = self.scores.tolist()
        self.kept = kept
        self.known: dict[str, str] = {}

    def lattice(
        self, text: str, space: tuple[float, float] = (GAP, GAP)
    ) -> list[list[tuple[tuple[int, ...], float]]]:
        """What each run of equal characters may stand for, with log probabilities; a space is dropped or kept."""
        steps = []
        for found in _RUN.finditer(text):
            c, k = found.group(1), len(found.group(0))
            if c in self.number:
                i = self.number[c]
                if k == 1:
                    steps.append([((i,), 0.0)])
                elif k == 2:
                    steps.append([((i, i), 0.0), ((i,), DOUBLE_FOR_ONE)])
                else:
                    steps.append([((i,), STRETCHED), ((i, i), STRETCHED - 0.4)])
            elif c in LOOK_ALIKES:
                options = [((), DROPPED_DIGIT if c.isdigit() else DROPPED)]
                for letter in LOOK_ALIKES[c]:
                    i = self.number[letter]
                    options.append(((i,), LOOK_ALIKE if k == 1 else LOOK_ALIKE + STRETCHED))
                    if k > 1:
                        options.append(((i, i), LOOK_ALIKE))
                steps.append(options)
            elif c == " ":
                steps.append([((), space[0]), ((0,), space[1])])
            else:
                steps.append([((), SEPARATOR)])
        return steps

    def decode(self, text: str) -> str:
        """The likeliest letters behind a text."""
        return self._decode(text)[1]

    def _decode(self, text: str, space: tuple[float, float] = (GAP, GAP)) -> tuple[float, str]:
        """Score of the likeliest path, and its letters."""
        model, size = self.model, self.size
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for options in self.lattice(text, space):
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (score, path) in states.items():
                for symbols, cost in options:
                    x, y, s, p = a, b, score + cost, path
                    for z in symbols:
                        s += model[(x * size + y) * size + z]
                        x, y, p = y, z, (p, z)
                    best = after.get((x, y))
                    if best is None or s > best[0]:
                        after[(x, y)] = (s, p)
            states = after
        ends = [(s + model[(a * size + b) * size], p) for (a, b), (s, p) in states.items()]
        score, path = max(ends, key=lambda e: e[0])
        letters = []
        while path:
            path, z = path
            letters.append(self.letters[z - 1] if z else " ")
        return score, "".join(reversed(letters)).strip()

    def score(self, word: str) -> float:
        """Log probability of a word as it stands, its end included."""
        x = y = 0
        total = 0.0
        for c in (*word, " "):
            z = self.number.get(c, 0)
            total += self.model[(x * self.size + y) * self.size + z]
            x, y = y, z
        return total

    def plausible(self, word: str) -> bool:
        return self.score(word) >= PLAUSIBLE * (len(word) + 1)

    def word(self, token: str) -> str:
        """A lower-case token as a word; empty if there is no letter in it."""
        found = self.known.get(token)
        if found is None:
            if token.isalpha() and token.isascii() and not _TWICE.search(token):
                return token
            if len(self.known) > self.kept:
                self.known.clear()
            found = self.known[token] = self._word(token)
        return found

    def _word(self, token: str) -> str:
        core = _HEAD.sub("", _TAIL.sub("", token)).strip(_EDGE)
        core = _HEAD.sub("", _TAIL.sub("", core))
        if not any(c.isalpha() for c in core):
            if sum(c in LOOK_ALIKES for c in core) < 3 or any(c.isalnum() and c not in LOOK_ALIKES for c in core):
                return ""
            word = self.decode(core)
            signs = sum(m.group(1) in LOOK_ALIKES for m in _RUN.finditer(core))
            return word if len(word) >= signs and self.plausible(word) else ""
        if any(c.isalpha() and c not in self.number for c in core):
            return core
        if _PLAIN.fullmatch(core) and not _THRICE.search(core):
            if core.isalpha() and not _TWICE.search(core):
                return core
            score, word = self._decode(core)
            return word if score > self.score(core) + DISGUISED else core
        return self.decode(core)

    def spaced(self, text: str) -> list[str]:
        """Words behind stretches of single characters and behind pieces that are likelier joined."""
        return self.stretches(text) + self.joined(text)

    def stretches(self, text: str, keys: Keys | None = None) -> list[str]:
        """Words behind stretches of single characters; with keys only of stretches that can hold one."""
        found = []
        for m in SPACED.finditer(text):
            pieces = m.group(0).split()
            if keys and not keys.walk({0}, "".join(pieces), anywhere=True)[0]:
                continue
            words = self.decode(" ".join(pieces)).split()
            found += words if any(c.isalpha() for c in m.group(0)) else filter(self.plausible, words)
        return found

    def joined(self, text: str) -> list[str]:
        """Words behind neighbouring pieces of which the best path drops a space, be it cheap or dear."""
        pieces = text.split()
        if len(pieces) < 2:
            return []
        codes = _code_points(f"  {' '.join(pieces)}  ")
        at = np.flatnonzero(codes == 32)[2:-2]
        x, y, z, w = (self.table[codes[at + k]].astype(np.int64) for k in (-2, -1, 1, 2))
        size, m = self.size, self.scores
        gain = m[(x * size + y) * size + z] + m[(y * size + z) * size + w]
        gain -= m[(x * size + y) * size] + m[y * size * size + z] + m[z * size + w]
        gain[(y == 0) | (z == 0)] = -np.inf
        found = []
        for space in (SPACE, (-DISGUISED, 0.0)):
            for first, last in _runs(np.flatnonzero(gain > -space[0]).tolist()):
                found += self.rejoined(pieces[first : last + 2], space)
        return found

    def rejoined(self, pieces: list[str], space: tuple[float, float] = SPACE) -> list[str]:
        """Words of the best path over some pieces and the spaces between them, but for the pieces themselves."""
        cores = [_HEAD.sub("", _TAIL.sub("", p)).strip(_EDGE) for p in pieces]
        words = self._decode(" ".join(c for c in cores if c), space)[1].split()
        return [w for w in words if w not in cores]


class Keys:
    """A trie of words (they end in a space) and beginnings of words, walked along the lattices of pieces."""

    def __init__(self, keys):
        self.after: list[dict[str, int]] = [{}]
        self.last, self.begun, self.whole = [""], [False], [False]
        for key in keys:
            node = 0
            for c in key.rstrip(" "):
                if c not in self.after[node]:
                    self.after[node][c] = len(self.after)
                    self.after.append({})
                    self.last.append(c)
                    self.begun.append(False)
                    self.whole.append(False)
                node = self.after[node][c]
            (self.whole if key.endswith(" ") else self.begun)[node] = True

    def walk(self, nodes: Iterable[int], piece: str, anywhere: bool = False) -> tuple[bool, set[int]]:
        """Whether a path over the piece completes a key, and the nodes where paths end. A word begins and
        ends with the piece, or at any of its characters; then the first key found ends the walk."""
        reached = False
        after, last, begun = self.after, self.last, self.begun
        for c in piece:
            if anywhere:
                nodes = {0, *nodes}
            letter = c.isalpha()
            step = set() if letter else set(nodes)
            for n in nodes:
                if letter and last[n] == c:
                    step.add(n)
                for stands in c if letter else (c, *LOOK_ALIKES.get(c, "")):
                    child = after[n].get(stands)
                    if child is not None:
                        step.add(child)
                        reached = reached or begun[child] or (anywhere and self.whole[child])
            nodes = step
            if anywhere and reached:
                break
            if not nodes and not anywhere:
                return reached, nodes
        return reached or any(self.whole[n] for n in nodes), set(nodes)


def _runs(numbers: list[int]) -> list[tuple[int, int]]:
    """First and last of the stretches of consecutive numbers."""
    found = []
    first = last = None
    for k in numbers:
        if last is None or k != last + 1:
            if last is not None:
                found.append((first, last))
            first = k
        last = k
    if last is not None:
        found.append((first, last))
    return found
