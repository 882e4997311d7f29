"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.workspace import ship_modules

# The white space between words, as characters.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER_BYTES = bytes.maketrans(_UPPER.encode(), _UPPER.lower().encode())
# Everything but digits, lower-case letters and the bytes of other scripts becomes a blank.
TERM_BYTES = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)


#: Rows go to Python in batches of at most so many bytes, however long the texts are.
BATCH_BYTES = "8m"


def prepare(spark: SparkSession) -> None:
    """Send this package's modules to the Python workers, once per application, and bound their batches."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    ship_modules(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(frame: DataFrame, base: str) -> str:
    """A column name that the frame doesn't have, whatever its letter case."""
    taken = {c.lower() for c in frame.columns}
    name = base
    while name.lower() in taken:
        name = f"_{name}"
    return name


def raw(text: str | None) -> bytes:
    """UTF-8 bytes of a text; null is empty."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def plain_words(text: str | None) -> list[bytes]:
    """Words between white space, unchanged (``bytes.split`` cuts at just these six bytes)."""
    return raw(text).split()


def folded_words(text: str | None) -> list[bytes]:
    """Words between white space with A-Z in lower case."""
    return raw(text).translate(LOWER_BYTES).split()


def terms(text: str | None) -> list[bytes]:
    """Lower-cased runs of digits, letters and characters beyond ASCII."""
    return raw(text).translate(TERM_BYTES).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """Finish a hash so that all its bits depend on all of the input's."""
    h = h ^ (h >> np.uint64(30))
    h = h * _MIX_1
    h = h ^ (h >> np.uint64(27))
    h = h * _MIX_2
    return h ^ (h >> np.uint64(31))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words; the result has ``len(words) - size + 1`` of them."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    for j in range(size):
        h = h * _MULTIPLIER + words[j : j + n]
    return mixed(h)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def chunks(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive groups whose sizes add up to at most ``most``, or that are one large item."""
    first = total = 0
    for k, size in enumerate(sizes):
        if total and total + size > most:
            yield first, k
            first, total = k, 0
        total += size
    if first < len(sizes):
        yield first, len(sizes)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow column of texts one after the other, and where each begins (and the last ends)."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    begins = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    whole = np.zeros(0, dtype=np.uint8) if data is None else np.frombuffer(data, dtype=np.uint8)
    return whole[begins[0] : begins[-1]], begins - begins[0]


def text_column(data: np.ndarray, begins: np.ndarray) -> pa.Array:
    """An Arrow column of texts from their bytes and begins."""
    offsets = pa.py_buffer(np.ascontiguousarray(begins, dtype=np.int64))
    column = pa.LargeStringArray.from_buffers(len(begins) - 1, offsets, pa.py_buffer(np.ascontiguousarray(data)))
    return column.cast(pa.string())
