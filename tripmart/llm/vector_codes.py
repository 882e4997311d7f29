"""Compression of vectors to short codes: one codebook for each part of the vectors, equal-average search.

Components become integers, the floor of 1024 times their value, and all that follows is exact. A vector is cut
into equal consecutive parts; each position has a codebook of entries. Codebooks begin as the parts of
the vectors of the smallest ids. In each round every part counts for its nearest entry (squared
distance, ties to the lower index), then every entry that has parts becomes the floor of their
mean. A code has the index of the nearest entry for each position.

**Search.** The squared gap of two vectors' component sums, divided by their dimension, is never
more than their squared distance. So the entries are sorted by sum, and the search goes outward from the
part's own sum, to both sides, until that bound strictly exceeds the best distance found; entries that
only equal it are still looked at, for they may tie. Parts of nearly equal sums walk together, some entries
at a time; one that is done on a side takes no part there any more.

**Scale.** A round is one scan: tasks keep a sum and a count for each entry and position, whatever the
number of rows, Spark adds these up, and the driver gets at most ``positions * entries * dimension of a part``
sums. Nothing else is collected but the vectors of the first codebook, and only the codebooks are sent to tasks.
Sums travel in limbs of 40 bits, so that they overflow at no size. Where doubles can't hold all
integers involved, the same search runs on Python's integers.

Rows are left out if their vector is null or holds a null, NaN or infinite component, or if it has another
length than that of the smallest id. Vectors whose length the parts don't divide count as filled up
with zeros. Rows without an id come last in the order of ids, those of the same id are ordered by
vector; repeated rows all count. With fewer rows than entries the codebooks are smaller; without
rows the result is empty. Columns other than id, vector and label aren't read. An error beyond 64 bits is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.workspace import written

#: Units of a component.
SCALE = 1024
#: Parts that walk outward together, and entries they look at in a step.
ROWS, STEP = 256, 16

_LIMB = 40
_EXACT = 1 << 53
_LARGEST = (1 << 63) - 1


@dataclass(frozen=True)
class Codebooks:
    """``entries[position][index]`` is a tuple of integers; ``length`` is that of the vectors."""

    entries: tuple[tuple[tuple[int, ...], ...], ...]
    length: int

    def digest(self) -> str:
        """SHA-256 of all components in decimal, joined by commas."""
        numbers = (str(x) for book in self.entries for entry in book for x in entry)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def scaled(values: np.ndarray) -> np.ndarray:
    """Floors of the scaled components: doubles if these hold them exactly, else Python's integers."""
    values = values.astype(np.float64)
    if not values.size or np.abs(values).max() < 2.0**43:
        return np.floor(values * SCALE)
    flat = [int(np.floor(x * SCALE)) if abs(x) < 2.0**43 else int(x) * SCALE for x in values.ravel().tolist()]
    return np.array(flat, dtype=object).reshape(values.shape)


def cut(vectors: np.ndarray, positions: int) -> np.ndarray:
    """``(rows, positions, dimension of a part)``, filled up with zeros where the length can't be divided."""
    rows, length = vectors.shape
    width = -(-length // positions)
    full = np.zeros((rows, positions * width), dtype=vectors.dtype)
    full[:, :length] = vectors
    return full.reshape(rows, positions, width)


def nearest(parts: np.ndarray, entries: list[tuple[int, ...]] | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each part the index of its nearest entry, ties to the lower index, and the squared distance."""
    n, width = parts.shape
    book = np.array([[int(x) for x in e] for e in entries], dtype=object).reshape(len(entries), width)
    index, best = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=object)
    if not n or not width:
        return index, best
    large = max(int(abs(x).max()) if x.size else 0 for x in (parts, book))
    far = 4 * width * large * large + 1
    kind = np.float64 if far * width < _EXACT else object
    parts = parts.astype(kind) if kind is np.float64 else np.array(
        [[int(x) for x in row] for row in parts.tolist()], dtype=object
    ).reshape(n, width)
    sums = book.sum(axis=1)
    order = np.array(sorted(range(len(book)), key=lambda i: (sums[i], i)), dtype=np.int64)
    sums, book = sums[order].astype(kind), book[order].astype(kind)
    squares = (book * book).sum(axis=1)
    totals, own = parts.sum(axis=1), (parts * parts).sum(axis=1)
    best = np.full(n, far, dtype=kind)
    rows = np.argsort(totals, kind="stable")
    for begin in range(0, n, ROWS):
        some = rows[begin : begin + ROWS]
        low = high = int(np.searchsorted(sums, totals[some[len(some) // 2]]))
        below, above = low > 0, high < len(book)
        while below or above:
            if above:
                gap = np.maximum(sums[high] - totals[some], 0)
                left = some[gap * gap <= best[some] * width]
                above = len(left) > 0
                if above:
                    to = min(high + STEP, len(book))
                    _look(parts, own, book, squares, order, left, slice(high, to), best, index)
                    high, above = to, to < len(book)
            if below:
                gap = np.maximum(totals[some] - sums[low - 1], 0)
                left = some[gap * gap <= best[some] * width]
                below = len(left) > 0
                if below:
                    to = max(low - STEP, 0)
                    _look(parts, own, book, squares, order, left, slice(to, low), best, index)
                    low, below = to, to > 0
    return index, best


def _look(parts, own, book, squares, order, rows, entries, best, index) -> None:
    """Compare parts with neighbouring entries and keep the nearest of them and those before."""
    found = own[rows][:, None] + squares[entries][None, :] - 2 * (parts[rows] @ book[entries].T)
    least = found.min(axis=1)
    numbers = np.where(found == least[:, None], order[entries][None, :], len(order)).min(axis=1)
    better = (least < best[rows]) | ((least == best[rows]) & (numbers < index[rows]))
    best[rows[better]], index[rows[better]] = least[better], numbers[better]


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return scaled(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), length))


def _summer(books: Codebooks):
    """Sums and counts of a task's parts by position and nearest entry, as (key, place, limb, value)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        positions, most = len(books.entries), len(books.entries[0])
        width = len(books.entries[0][0])
        sums = np.zeros((positions * most, width + 1), dtype=object)
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = cut(_matrix(batch.column(0), books.length), positions)
            for p in range(positions):
                index, _ = nearest(parts[:, p], books.entries[p])
                order = np.argsort(index, kind="stable")
                used, begins = np.unique(index[order], return_index=True)
                # A batch's sums of doubles below 2**53 stay exact only as integers.
                rows = parts[order, p]
                rows = rows.astype(np.int64) if rows.dtype != object and _fits(rows) else _whole(rows)
                sums[p * most + used, :width] += np.add.reduceat(rows, begins, axis=0).astype(object)
                sums[p * most + used, width] += np.diff(begins, append=len(order)).astype(object)
        found = []
        for key in np.flatnonzero(sums[:, width] > 0).tolist():
            for place, value in enumerate(sums[key].tolist()):
                limb = 0
                while value not in (0, -1):
                    found.append((key, place, limb, value & ((1 << _LIMB) - 1)))
                    value, limb = value >> _LIMB, limb + 1
                if value:
                    found.append((key, place, limb, value))
        if found:
            columns = [pa.array(c, type=t) for c, t in zip(zip(*found, strict=True), _KINDS, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "place", "limb", "value"])

    return run


_KINDS = (pa.int32(), pa.int32(), pa.int32(), pa.int64())


def _fits(values: np.ndarray) -> bool:
    return not values.size or float(np.abs(values).max()) * len(values) < 2.0**62


def _whole(values: np.ndarray) -> np.ndarray:
    return np.array([[int(x) for x in row] for row in values.tolist()], dtype=object).reshape(values.shape)


def _coder(books: Codebooks, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        positions = len(books.entries)
        digits = max(2, len(f"{max(len(books.entries[0]) - 1, 0):x}"))
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            parts = cut(_matrix(batch.column(batch.num_columns - 1), books.length), positions)
            found = [nearest(parts[:, p], books.entries[p]) for p in range(positions)]
            codes = ["".join(f"{i:0{digits}x}" for i in row) for row in zip(*(i.tolist() for i, _ in found), strict=True)]
            errors = [sum(map(int, row)) for row in zip(*(d.tolist() for _, d in found), strict=True)]
            errors = pa.array([e if e <= _LARGEST else None for e in errors], type=pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(codes, type=pa.string()), errors], names)

    return run


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector is there and has finite components only."""
    finite = F.forall(
        column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )
    return vectors.where(F.col(column).isNotNull() & finite)


def train(
    vectors: DataFrame, positions: int = 4, entries: int = 256, rounds: int = 4, column: str = "embedding"
) -> Codebooks | None:
    """Codebooks for ``vec_id`` and a vector column; None without usable rows."""
    kept = usable(vectors, column).select("vec_id", F.col(column).cast("array<double>").alias("v"))
    first = kept.select("vec_id", F.size("v").alias("n"), "v").orderBy(F.asc_nulls_last("vec_id"), "v").limit(1).collect()
    if not first:
        return None
    length = first[0]["n"]
    kept = kept.where(F.size("v") == length)
    begin = kept.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()
    parts = cut(scaled(np.array([r["v"] for r in begin], dtype=np.float64).reshape(len(begin), length)), positions)
    books = [[tuple(int(x) for x in part) for part in parts[:, p].tolist()] for p in range(positions)]
    width = parts.shape[2]
    for _ in range(rounds if width else 0):
        now = Codebooks(tuple(map(tuple, books)), length)
        sums = kept.select("v").mapInArrow(_summer(now), "key int, place int, limb int, value long")
        totals: dict[tuple[int, int], int] = {}
        for r in sums.groupBy("key", "place", "limb").agg(F.sum("value").alias("value")).toLocalIterator():
            totals[r["key"], r["place"]] = totals.get((r["key"], r["place"]), 0) + (r["value"] << (_LIMB * r["limb"]))
        for key in {k for k, _ in totals}:
            count = totals[key, width]
            books[key // len(begin)][key % len(begin)] = tuple(totals.get((key, k), 0) // count for k in range(width))
    return Codebooks(tuple(map(tuple, books)), length)


def encode(vectors: DataFrame, books: Codebooks, column: str = "embedding") -> DataFrame:
    """Usable rows with ``code`` (indices in hex digits, in order of positions) and ``error`` in place of the vector."""
    kept = usable(vectors, column).where(F.size(column) == books.length)
    rest = kept.drop(column, "code", "error")
    schema = rest.select("*", F.lit("").cast("string").alias("code"), F.lit(0).cast("long").alias("error")).schema
    rows = kept.select(*rest.columns, F.col(column).cast("array<double>").alias("_v"))
    return rows.mapInArrow(_coder(books, schema.names), schema)


def _speller(books: Codebooks, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digits = max(2, len(f"{max(len(books.entries[0]) - 1, 0):x}"))
        for batch in batches:
            vectors = []
            for code in batch.column(batch.num_columns - 1).to_pylist():
                parts = (book[int(code[p * digits : (p + 1) * digits], 16)] for p, book in enumerate(books.entries))
                vectors.append([x / SCALE for part in parts for x in part][: books.length])
            found = pa.array(vectors, type=pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], found], names)

    return run


def reconstructed(codes: DataFrame, books: Codebooks) -> DataFrame:
    """Rows of codes with the vector ``decoded`` that they stand for, which replaces a column of that name."""
    rest = codes.drop("decoded")
    schema = rest.select("*", F.array(F.lit(0.0)).alias("decoded")).schema
    rows = rest.select("*", F.col("code").alias("_code"))
    return rows.mapInArrow(_speller(books, schema.names), schema)


def op11_vector_codes(embeddings: DataFrame) -> DataFrame:
    """Codes of all usable vectors, their errors by row and by label, and the digest of the codebooks."""
    spark = embeddings.sparkSession
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label"), F.col("embedding").alias("embedding")
    )
    books = train(rows)
    empty = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    if books is None:
        return spark.createDataFrame([], empty)
    codes = written(spark, encode(rows, books), "vector-codes")
    by_label = codes.groupBy(F.col("label").alias("of")).agg(F.try_sum("error").alias("label_error"))
    return codes.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256")
    )

