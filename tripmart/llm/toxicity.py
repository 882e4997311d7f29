"""Toxicity of restored text.

A character model over all documents restores disguised words (``noisy_channel``). Evidence is then
weighed per restored word: the log odds of the word, or of its beginning, among toxic and clean
training documents. A document's strongest word, the sum of its words and that sum against its number of
distinct pieces go into a logistic regression. For fitting it, each half of the training documents is weighed
by the other half; scores use the weights of both. Scoring decodes only pieces, and neighbours of pieces, whose
lattice holds a weighted word; all others weigh nothing whatever they stand for.

Training takes a bounded sample of the labelled rows: at most ``SAMPLE`` of either class, by the
hash of their id. The weights kept are bounded too (``WEIGHTS``). Counts of characters, and
scores, cover all documents.

Null and empty texts have no words; their score is that of no evidence. Labels without a document, or
null, are left out. Without toxic or without clean training rows every score is the share of ones
(0 without any). Repeated rows are scored each; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm import noisy_channel
from tripmart.llm.noisy_channel import LETTERS, Keys, Restorer, character_counts, character_model, corpus_letters
from tripmart.llm.quality_classifier import fold
from tripmart.workspace import written

SAMPLE = 8000
WEIGHTS = 20_000
MIN_DOCUMENTS = 4
MIN_WEIGHT = 2.0
BEGINNINGS = (3, 4, 5, 6, 7)
THRESHOLD = 0.3


def evidence_of(word: str) -> list[str]:
    """The word and its beginnings, as keys of weights."""
    return [f"{word} ", *(word[:k] for k in BEGINNINGS if len(word) >= k)]


def words_of(text: str | None, restorer: Restorer) -> set[str]:
    """Distinct restored words of pieces and of stretches of single characters."""
    if not text:
        return set()
    lower = text.lower()
    found = set(map(restorer.word, set(lower.split())))
    found.update(restorer.stretches(lower))
    found.discard("")
    return found


_RESTORERS: dict[str, Restorer] = {}


def _shared(context, characters: np.ndarray, letters: str):
    """A character model for all tasks, under a name of its own."""
    return context.broadcast((uuid.uuid4().hex, characters, letters))


def _restorer(shared) -> Restorer:
    """One restorer per worker for each model."""
    name, characters, letters = shared.value
    if name not in _RESTORERS:
        _RESTORERS.clear()
        _RESTORERS[name] = Restorer(characters, letters=letters)
    return _RESTORERS[name]


def _tally(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = _restorer(shared)
        for batch in batches:
            counts = [Counter() for _ in range(4)]
            rows = zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)
            for half, label, text in rows:
                found: set[str] = set()
                for word in words_of(text, restorer):
                    found.update(evidence_of(word))
                counts[2 * half + label].update(found)
            keys = list(set().union(*counts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), *(pa.array([c[k] for k in keys], pa.int64()) for c in counts)],
                ["key", "clean_0", "toxic_0", "clean_1", "toxic_1"],
            )

    return run


#: How many pieces after the one that completes a weighted key are decoded with it.
FOLLOWING = 1
#: Characters of a piece that are walked once for all pieces that begin with them.
HEAD = 3


@dataclass
class Weigher:
    """Weights of words, by word; the strongest key counts."""

    weights: dict[str, float]

    def __post_init__(self):
        self.keys = Keys(self.weights)
        self.longest = max(map(len, self.weights), default=0)
        self.heads: dict[str, bool] = {}
        self.pieces: dict[str, tuple | None] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    def word(self, word: str) -> float:
        return max((self.weights.get(k, 0.0) for k in evidence_of(word)), default=0.0)

    def _piece(self, piece: str, restorer: Restorer) -> tuple[str, tuple[int, ...], str] | None:
        """The word behind a piece that can hold a weighted one, where a key that goes on may stand, and the letters
        that it may go on with; None if there is neither."""
        reached, nodes = self.keys.walk({0}, piece)
        nodes.discard(0)
        word = restorer.word(piece) if reached else ""
        on = "".join({c for n in nodes for c in (*self.keys.after[n], self.keys.last[n])})
        return (word, tuple(nodes), on) if word or nodes else None

    def _known(self, pieces: set[str], restorer: Restorer) -> dict[str, tuple]:
        """What is known of those pieces that may matter; most are settled by their first characters."""
        for kept in (self.heads, self.pieces, self.pairs):
            if len(kept) > 200_000:
                kept.clear()
        found = {}
        for piece in pieces:
            head = piece[:HEAD]
            alive = self.heads.get(head)
            if alive is None:
                reached, nodes = self.keys.walk({0}, head)
                alive = self.heads[head] = reached or bool(nodes)
            if alive:
                if piece not in self.pieces:
                    self.pieces[piece] = self._piece(piece, restorer)
                if self.pieces[piece]:
                    found[piece] = self.pieces[piece]
        return found

    def words(self, text: str, restorer: Restorer, pieces: list[str] | None = None) -> set[str]:
        """The restored words that may have a weight."""
        pieces = text.split() if pieces is None else pieces
        found = set(restorer.stretches(text, self.keys))
        known = self._known(set(pieces), restorer)
        found.update(word for word, _, _ in known.values() if word)
        for k in [k for k, piece in enumerate(pieces[:-1]) if piece in known]:
            _, nodes, on = known[pieces[k]]
            first = pieces[k + 1][0]
            if nodes and (first in on or not first.isalpha()):
                pair = pieces[k], pieces[k + 1][:HEAD]
                alive = self.pairs.get(pair)
                if alive is None:
                    reached, left = self.keys.walk(nodes, pair[1])
                    alive = self.pairs[pair] = reached or bool(left)
                if alive:
                    found.update(self._across(pieces, k, nodes, restorer))
        return found

    def _across(self, pieces: list[str], first: int, nodes: Iterable[int], restorer: Restorer) -> list[str]:
        """Words of the best path over a piece and its successors, if a key goes on over the spaces: over pieces up
        to twice the longest key's characters, and not over two in a row without a letter."""
        bare = not any(map(str.isalpha, pieces[first]))
        for k in range(first + 1, min(len(pieces), first + 2 * self.longest)):
            before, bare = bare, not any(map(str.isalpha, pieces[k]))
            if before and bare:
                return []
            reached, nodes = self.keys.walk(nodes, pieces[k])
            if reached:
                return restorer.rejoined(pieces[first : k + 1 + FOLLOWING], noisy_channel.SPACE_IN_KEY)
            if not nodes:
                return []
        return []

    def document(self, text: str | None, restorer: Restorer) -> list[float]:
        """The strongest weight, the sum of weights, and that against the number of distinct pieces."""
        lower = (text or "").lower()
        pieces = lower.split()
        found = [w for w in map(self.word, self.words(lower, restorer, pieces)) if w]
        total = sum(found)
        return [max(found, default=0.0), float(np.log1p(total)), total / (1 + np.sqrt(len(set(pieces))))]


def _evidence(shared, weighers):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, weigh = _restorer(shared), weighers.value
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)
            x = [weigh[1 - half].document(t, restorer) for half, t in rows]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(x, pa.list_(pa.float64()))], ["label", "x"])

    return run


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Coefficients (the first is the intercept) by Newton's method."""
    x1 = np.hstack([np.ones((len(x), 1)), x])
    beta = np.zeros(x1.shape[1])
    penalty = ridge * np.eye(len(beta))
    penalty[0, 0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x1 @ beta, -30, 30)))
        grad = x1.T @ (y - p) - penalty @ beta
        hess = (x1 * (p * (1 - p))[:, None]).T @ x1 + penalty
        step = np.linalg.solve(hess, grad)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


@dataclass
class Model:
    characters: np.ndarray
    weights: dict[str, float]
    beta: np.ndarray
    flat: float | None = None
    letters: str = LETTERS


def _sample(labels: DataFrame, bound: int) -> DataFrame:
    """At most ``bound`` labelled ids of either class, by the hash of the id."""
    order = F.xxhash64("doc_id", F.lit(7))
    some = [labels.where(f"label = {c}").orderBy(order, "doc_id").limit(bound) for c in (0, 1)]
    return some[0].union(some[1])


def fit(documents: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> Model:
    """Character model, word weights and regression from ``doc_id, text`` and ``doc_id, label``."""
    spark = documents.sparkSession
    letters = corpus_letters(documents)
    characters = character_model(character_counts(documents, letters))
    chosen = {(r["doc_id"], r["label"]) for r in _sample(labels, bound).collect()}
    shares = [sum(label == c for _, label in chosen) for c in (0, 1)]
    if not all(shares):
        return Model(characters, {}, np.zeros(4), 1.0 if shares[1] else 0.0, letters)
    sample = spark.createDataFrame(sorted(chosen), "doc_id long, label int")
    sample = sample.withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(2)).cast("int"))
    texts = documents.join(F.broadcast(sample), "doc_id").select("half", "label", "text")
    shared = _shared(spark.sparkContext, characters, letters)
    parts = ("clean_0", "toxic_0", "clean_1", "toxic_1")
    schema = ", ".join(["key string", *(f"{c} long" for c in parts)])
    tally = texts.mapInArrow(_tally(shared), schema).groupBy("key").agg(*(F.sum(c).alias(c) for c in parts))
    tally = written(spark, tally.where(F.col("toxic_0") + F.col("toxic_1") >= MIN_DOCUMENTS), "word-tally")
    many = {(r["half"], r["label"]): r["count"] for r in sample.groupBy("half", "label").count().collect()}

    def weights(halves: tuple[int, ...]) -> dict[str, float]:
        clean, toxic = (sum((F.col(f"{c}_{h}") for h in halves), F.lit(0)) for c in ("clean", "toxic"))
        n_clean, n_toxic = (sum(many.get((h, y), 0) for h in halves) + 1.0 for y in (0, 1))
        weight = F.log((toxic + 0.5) / n_toxic) - F.log((clean + 0.5 + 0.25 * F.sqrt(clean)) / n_clean)
        best = (
            tally.where(toxic >= MIN_DOCUMENTS)
            .select("key", (weight - 1.5 / F.sqrt(toxic)).alias("weight"))
            .where(F.col("weight") >= MIN_WEIGHT)
            .orderBy(F.desc("weight"), "key")
            .limit(WEIGHTS)
        )
        return {r["key"]: r["weight"] for r in best.collect()}

    weighers = spark.sparkContext.broadcast([Weigher(weights((h,))) for h in (0, 1)])
    rows = texts.mapInArrow(_evidence(shared, weighers), "label int, x array<double>")
    points = sorted((r["label"], *r["x"]) for r in rows.collect())
    table = np.array(points, dtype=np.float64).reshape(-1, 4)
    y = table[:, 0]
    beta = logistic(table[:, 1:], y) if 0 < y.sum() < len(y) else np.zeros(4)
    return Model(characters, weights((0, 1)), beta, letters=letters)


def _scorer(characters, weigher, beta: list[float], flat: float | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, weigh = _restorer(characters), weigher.value
        for batch in batches:
            rows = [weigh.document(t, restorer) for t in batch.column(1).to_pylist()]
            x = np.array(rows, dtype=np.float64).reshape(-1, 3)
            score = 1 / (1 + np.exp(-np.clip(beta[0] + x @ np.array(beta[1:]), -30, 30)))
            if flat is not None:
                score = np.full(len(x), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["doc_id", "score"])

    return run


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` for each document."""
    context = documents.sparkSession.sparkContext
    characters = _shared(context, model.characters, model.letters)
    weigher = context.broadcast(Weigher(model.weights))
    run = _scorer(characters, weigher, model.beta.tolist(), model.flat)
    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def _restore(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = _restorer(shared)
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                lower = (text or "").lower()
                plain = [w for w in map(restorer.word, lower.split()) if w]
                out.append(" ".join([*plain, *restorer.spaced(lower)]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["doc_id", "restored"])

    return run


def restored(documents: DataFrame, characters: np.ndarray, letters: str = LETTERS) -> DataFrame:
    """``doc_id, restored``: the words behind each text, then those behind spaced letters."""
    shared = _shared(documents.sparkSession.sparkContext, characters, letters)
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _restore(shared), "doc_id long, restored string"
    )


def op1_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Score and prediction for every document; labels of fold 2 of 4 aren't learnt from."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
    known = known.where("label in (0, 1)").where(fold(F.col("doc_id"), 4) != 2)
    model = fit(docs, known)
    held = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    return scored(docs, model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
