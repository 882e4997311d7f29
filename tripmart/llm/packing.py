"""Best-fit packing of token sequences by exact complements.

The plan is made from the histogram of lengths alone, whose size is bounded by the capacity: for
each length, from the longest down, the index of available lengths is asked for one, two or three
others that fill the gap exactly, and as many such sequences are taken as the counts allow. What
is left goes best-fit into the smallest gaps. Steps handle counts, not items, so the plan's size
doesn't grow with the data.

Pieces are then numbered within their length, in salted groups so that a length which a third of
all pieces share is numbered by many tasks, and each number is looked up in the plan. No step
gathers pieces.

A null text is empty and has the end id alone; longer documents are cut into pieces of the
capacity. Repeated rows are packed each. An empty table gives an empty result.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import free_name
from tripmart.llm.tokens import encoder, file_of
from tripmart.workspace import written

CAPACITY = 4096
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_NAMES = ("doc_id", "piece", "start", "length", "ids_crc32")


@dataclass
class Plan:
    """For pieces of ``length`` numbered from ``low``: the first one's sequence, and the offset."""

    length: np.ndarray
    low: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


class _Stock:
    """How many pieces of each length are left."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = np.zeros(capacity + 1, dtype=np.int64)
        for length, count in counts.items():
            self.left[length] = count

    def times(self, pattern: tuple[int, ...]) -> int:
        return min(int(self.left[x]) // pattern.count(x) for x in set(pattern))

    def take(self, pattern: tuple[int, ...], times: int) -> None:
        for x in pattern:
            self.left[x] -= times

    def _pair(self, length: int, gap: int, least: int) -> tuple[int, ...] | None:
        """The most plentiful pair of lengths, each at least ``least``, that fills the gap."""
        small = np.arange(least, gap // 2 + 1)
        if not len(small):
            return None
        both = np.minimum(self.left[small], self.left[gap - small])
        for k in (int(both.argmax()), *np.flatnonzero(both)):
            if self.times((length, gap - int(small[k]), int(small[k]))):
                return gap - int(small[k]), int(small[k])
        return None

    def complement(self, length: int) -> tuple[int, ...] | None:
        """One, two or three available lengths that fill the gap beside ``length`` exactly."""
        gap = len(self.left) - 1 - length
        if gap == 0:
            return ()
        if self.times((length, gap)):
            return (gap,)
        if pair := self._pair(length, gap, 1):
            return pair
        for third in np.flatnonzero(self.left[1 : gap // 3 + 1])[::-1] + 1:
            rest = gap - int(third)
            small = np.arange(int(third), rest // 2 + 1)
            for k in np.flatnonzero((self.left[small] > 0) & (self.left[rest - small] > 0)):
                triple = (rest - int(small[k]), int(small[k]), int(third))
                if self.times((length, *triple)):
                    return triple
        return None


def _best_fit(stock: _Stock) -> list[tuple[tuple[int, ...], int]]:
    """Longest first, each into the smallest gap that holds it, many equal ones at a time."""
    capacity = len(stock.left) - 1
    bins: list[dict[tuple[int, ...], int]] = [{} for _ in range(capacity + 1)]
    filled = np.zeros(capacity + 1, dtype=bool)
    for length in np.flatnonzero(stock.left)[::-1].tolist():
        count = int(stock.left[length])
        while count:
            gaps = np.flatnonzero(filled[length:])
            if not len(gaps):
                each = min(count, capacity // length)
                times = count // each
                pattern = (length,) * each
                gap = capacity - length * each
                bins[gap][pattern] = bins[gap].get(pattern, 0) + times
                filled[gap] = True
                count -= each * times
                continue
            gap = length + int(gaps[0])
            pattern, times = bins[gap].popitem()
            used = min(times, count)
            if used < times:
                bins[gap][pattern] = times - used
            filled[gap] = bool(bins[gap])
            longer = (*pattern, length)
            bins[gap - length][longer] = bins[gap - length].get(longer, 0) + used
            filled[gap - length] = True
            count -= used
    return [x for b in bins for x in b.items()]


def patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Lengths that go into one sequence together, and how many such sequences there are."""
    stock = _Stock(counts, capacity)
    chosen: list[tuple[tuple[int, ...], int]] = []
    for length in range(capacity, 0, -1):
        while stock.left[length] and (others := stock.complement(length)) is not None:
            pattern = (length, *others)
            times = stock.times(pattern)
            stock.take(pattern, times)
            chosen.append((pattern, times))
    return chosen + _best_fit(stock)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Ranges of piece numbers by length, each with the sequences that take them."""
    used: dict[int, int] = {}
    rows: list[tuple[int, int, int, int]] = []
    sequence = 0
    for pattern, times in patterns(counts, capacity):
        offset = 0
        for length in pattern:
            low = used.get(length, 0)
            rows.append((length, low, sequence, offset))
            used[length] = low + times
            offset += length
        sequence += times
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 4)
    return Plan(table[:, 0], table[:, 1], table[:, 2], table[:, 3], sequence)


def _cutter(tokenizer: str, end_id: int | None, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(tokenizer)
        end = b"" if end_id is None else struct.pack("<I", end_id)
        step = 4 * capacity
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(ids), 1024):
                rows, contents = [], []
                for doc_id, data in zip(ids[at : at + 1024], codec.encode(texts[at : at + 1024]), strict=True):
                    data += end
                    for k in range(0, len(data), step):
                        part = data[k : k + step]
                        rows.append((doc_id, k // step, k // 4, len(part) // 4, zlib.crc32(part)))
                        contents.append(part)
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                arrays = [pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)]
                if with_ids:
                    arrays.append(pa.array(contents, type=pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, [*_NAMES, *["ids"] * with_ids])

    return run


def pieces(
    documents: DataFrame,
    tokenizer: str,
    end_id: int | None = None,
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """Token pieces of at most the capacity; with their ids (32-bit little-endian) on demand."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = _PIECES + (", ids binary" if with_ids else "")
    return rows.mapInArrow(_cutter(tokenizer, end_id, capacity, with_ids), schema)


def _placer(shared, names: list[str], length: str, number: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen: Plan = shared.value
        first = np.searchsorted(chosen.length, np.arange(chosen.length[-1] + 2) if len(chosen.length) else [0])
        for batch in batches:
            lengths = batch.column(length).to_numpy()
            numbers = batch.column(number).to_numpy()
            at = np.zeros(len(lengths), dtype=np.int64)
            for x in np.unique(lengths).tolist():
                mine = lengths == x
                a, b = int(first[x]), int(first[x + 1])
                at[mine] = a + np.searchsorted(chosen.low[a:b], numbers[mine], side="right") - 1
            arrays = [batch.column(c) for c in names]
            arrays += [pa.array(chosen.sequence[at] + numbers - chosen.low[at]), pa.array(chosen.offset[at])]
            yield pa.RecordBatch.from_arrays(arrays, [*names, "sequence_id", "offset"])

    return run


def numbered(parts: DataFrame, length: str, salts: int, order: list[str]) -> tuple[DataFrame, str]:
    """Number rows from 0 within their length, whatever share of the rows has it."""
    salt, number = free_name(parts, "salt"), free_name(parts, "number")
    salted = parts.withColumn(salt, F.pmod(F.xxhash64(*order), F.lit(salts)))
    groups = salted.groupBy(length, salt).agg(F.count(F.lit(1)).alias("_many"))
    before = Window.partitionBy(length).orderBy(salt).rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(length, salt, F.coalesce(F.sum("_many").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy(length, salt).orderBy(*order)
    rows = salted.withColumn(number, F.row_number().over(within).cast("long") - 1).join(groups, [length, salt])
    return rows.withColumn(number, F.col(number) + F.col("_before")).select(*parts.columns, number), number


def place(parts: DataFrame, order: list[str], length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``. ``parts`` is read three times: pass a table."""
    spark = parts.sparkSession
    histogram = {r[0]: r[1] for r in parts.groupBy(length).count().collect()}
    shared = spark.sparkContext.broadcast(plan(histogram, capacity))
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows, number = numbered(parts, length, salts, order)
    schema = ", ".join(f"`{c}` {t}" for c, t in parts.dtypes) + ", sequence_id long, offset long"
    return rows.mapInArrow(_placer(shared, parts.columns, length, number), schema)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences, from pieces with ids: at most a capacity's ids in each group."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "piece", "ids")))
    return (
        placed.groupBy("sequence_id")
        .agg(parts.alias("parts"))
        .select(
            "sequence_id",
            F.expr("aggregate(parts, cast('' as binary), (s, p) -> concat(s, p.ids))").alias("ids"),
            F.expr("transform(parts, p -> struct(p.offset, p.length, p.doc_id, p.piece))").alias("parts"),
        )
    )


def pack_documents(
    documents: DataFrame, tokenizer: str | None = None, end_id: int = 1, capacity: int = CAPACITY
) -> DataFrame:
    parts = pieces(documents, tokenizer or file_of("word_bpe_49k.json"), end_id, capacity)
    table = written(documents.sparkSession, parts, "pieces")
    return place(table, ["doc_id", "piece", "ids_crc32"], capacity=capacity)


def op5_best_fit_packing(documents: DataFrame) -> DataFrame:
    """All documents as pieces with their place in packed sequences."""
    return pack_documents(documents)
