"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each document gives a short vector of statistics (lengths, shares of kinds of characters, repetition),
transformed to be closer to normal. Every training row adds to sums and products per class, which
Spark adds up; from these come means and covariances, shrunk towards the pooled covariance and its
diagonal. The Cholesky factor of either class is computed once and sent to the tasks, where a
score is the logistic function of the difference of the two log densities and the log prior odds.

The table of statistics is written once and read by training and scoring; texts aren't shuffled.

Null and empty texts have the statistics of no words. Labels without a document, or null, are left
out; several labels of a document all count. If a class has no training row, the score is the share
of ones (0.5 without any row). Repeated rows are scored each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import raw
from tripmart.workspace import written

STATISTICS = (
    "words",
    "word_length",
    "upper",
    "digits",
    "symbols",
    "bars",
    "shouts",
    "stops",
    "beyond_ascii",
    "distinct",
    "top_word",
    "line_words",
    "repeated_lines",
)
#: Share of the pooled covariance, then of the diagonal.
POOLED = 0.1
DIAGONAL = 0.05
THRESHOLD = 0.3

_KIND = np.zeros((256, 7), dtype=np.float64)
for _k, _chars in enumerate(
    (
        bytes(range(0x41, 0x5B)),
        bytes(range(0x30, 0x3A)),
        b"#*$%&<>",
        b"|",
        b"!",
        b".,;:?",
        bytes(range(0x80, 0x100)),
    )
):
    _KIND[list(_chars), _k] = 1


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one document."""
    data = raw(text)
    words = data.split()
    n = len(words)
    size = sum(map(len, words))
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256) @ _KIND
    upper, digits, symbols, bars, shouts, stops, beyond = counts.tolist()
    tally = Counter(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    top = max(tally.values(), default=0)
    per_word, per_byte = 1 / max(n, 1), 1 / max(size, 1)
    values = (
        np.log1p(n),
        np.log1p(size * per_word),
        np.sqrt(upper * per_byte),
        np.sqrt(digits * per_byte),
        np.arcsinh(4 * symbols * per_word),
        np.arcsinh(4 * bars * per_word),
        np.arcsinh(4 * shouts * per_word),
        np.arcsinh(4 * stops * per_word),
        np.sqrt(beyond * per_byte),
        len(tally) * per_word,
        np.sqrt(top * per_word),
        np.log1p(n / max(len(lines), 1)),
        1 - len(set(lines)) / max(len(lines), 1),
    )
    return [float(x) for x in values]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([statistics(t) for t in batch.column(1).to_pylist()], pa.list_(pa.float64()))],
            ["doc_id", "x"],
        )


def measured(documents: DataFrame) -> DataFrame:
    """``doc_id`` and the vector of statistics."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_measure, "doc_id long, x array<double>")


@dataclass
class Discriminant:
    """Per class: mean and Cholesky factor of the shrunk covariance, with half its log determinant."""

    means: np.ndarray
    factors: np.ndarray
    half_dets: np.ndarray
    odds: float
    flat: float | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.flat is not None:
            return np.full(len(x), self.flat)
        logs = []
        for mean, factor, half in zip(self.means, self.factors, self.half_dets, strict=True):
            z = np.linalg.solve(factor, (x - mean).T)
            logs.append(-0.5 * (z * z).sum(axis=0) - half)
        margin = np.clip(logs[1] - logs[0] + self.odds, -30, 30)
        return 1 / (1 + np.exp(-margin))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch and class the entries of the sums of 1, x and x x^T."""
    for batch in batches:
        y = np.array(batch.column(0).to_pylist(), dtype=np.int64)
        if not len(y):
            continue
        x = np.array(batch.column(1).to_pylist(), dtype=np.float64)
        x1 = np.hstack([np.ones((len(x), 1)), x])
        sums = np.concatenate([(x1[y == c].T @ x1[y == c]).ravel() for c in (0, 1)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums))), pa.array(sums)], ["entry", "value"])


def fit(vectors: DataFrame, size: int = len(STATISTICS), pooled: float = POOLED, diagonal: float = DIAGONAL):
    """The discriminant from ``label, x`` rows, all of them."""
    sums = vectors.select("label", "x").mapInArrow(_moments, "entry long, value double")
    flat = np.zeros(2 * (size + 1) ** 2)
    for r in sums.groupBy("entry").agg(F.sum("value").alias("value")).collect():
        flat[r["entry"]] = r["value"]
    both = flat.reshape(2, size + 1, size + 1)
    many = both[:, 0, 0]
    if not many.all():
        return Discriminant(np.zeros((2, size)), np.zeros((2, size, size)), np.zeros(2), 0.0, float(many[1] / max(many.sum(), 1)) if many.any() else 0.5)
    means = both[:, 0, 1:] / many[:, None]
    own = both[:, 1:, 1:] / many[:, None, None] - means[:, :, None] * means[:, None, :]
    shared = (own * many[:, None, None]).sum(axis=0) / many.sum()
    scale = np.diag(np.maximum(np.diag(shared), 1e-6))
    factors = []
    for c in (0, 1):
        cov = (1 - pooled) * own[c] + pooled * shared
        cov = (1 - diagonal) * cov + diagonal * scale
        factors.append(np.linalg.cholesky(cov + 1e-9 * np.eye(size)))
    half = np.array([np.log(np.diag(f)).sum() for f in factors])
    return Discriminant(means, np.array(factors), half, float(np.log(many[1] / many[0])))


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Discriminant = shared.value
        for batch in batches:
            if batch.num_rows:
                x = np.array(batch.column(1).to_pylist(), dtype=np.float64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(model.scores(x))], ["doc_id", "score"]
                )

    return run


def scored(vectors: DataFrame, model: Discriminant) -> DataFrame:
    shared = vectors.sparkSession.sparkContext.broadcast(model)
    return vectors.select("doc_id", "x").mapInArrow(_scorer(shared), "doc_id long, score double")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def op7_quality_classifier(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Score and prediction for every document; labels of fold 0 of 5 aren't learnt from."""
    spark = documents.sparkSession
    vectors = written(spark, measured(documents), "statistics")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    known = known.where("label in (0, 1)").where(fold(F.col("doc_id"), 5) != 0)
    model = fit(vectors.join(known, "doc_id"))
    held = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    return scored(vectors, model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
