"""Substring deduplication by seed and extend.

Seeds are winnowed anchors: of the five-word grams in every window of 13 words, the one with the
smallest hash. Equal windows have equal anchors, so documents that share a passage of 13 words or
more meet at its anchors, while only a fifth of all positions is an anchor. An anchor's *run* is
the stretch of words of all windows that chose it, that is, the anchor extended both ways.

1. Runs are grouped by anchor and content. A run that also lies in a document with a smaller id is
   repeated as a whole. Others that share their anchor with different runs may match in part.
2. For these alone, the extension goes window by window: each 13-word window is looked up among the
   windows of the other runs at its anchor.
3. Overlapping finds are merged into maximal repeats, and their words are removed.

Each task reduces equal runs of its batches to those of the smallest id before the shuffle (the
others are repeated, whatever the rest of the corpus holds), so a passage that a third of all
documents share contributes a row per batch, not per document. A shorter phrase that very many
documents share has as many different runs; such anchors are counted first, and their runs are dealt
by content. No pairs of documents are formed.
Anchors and runs, or anchors and windows, are compared by two independent 64-bit hashes.

A null text has no words and a null id neither removes nor loses anything. Rows of the same id are
judged as one document's versions: they don't remove each other's words. An empty table gives an
empty result. Other columns, whatever their names, stay as they are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm.common import WORD_CLASS, chunks, free_name, gram_hashes, mixed, plain_words, signed, word_hashes
from tripmart.workspace import written

WINDOW = 13
GRAM = 5
CHUNK_WORDS = 1 << 20
#: Different runs of an anchor: in a batch to be counted, in all to be crowded; the most crowded anchors.
SEVERAL, CROWDED, MOST_CROWDED = 8, 128, 20_000

_FACTOR = 0xD6E8FEB86659FD93
_RUNS = "a long, r long, doc_id long, v int, start int, stop int, known boolean, crowded boolean"
_FAR = np.int64(1) << np.int64(40)


def _joined(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row, and where each text begins (and the last ends)."""
    hashes = [word_hashes(plain_words(t)) for t in texts]
    begins = np.concatenate([[0], np.cumsum([len(h) for h in hashes])]).astype(np.int64)
    return (np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)), begins


def _span_hashes(words: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A polynomial hash of each stretch of words, independent of where it lies."""
    n = len(words)
    with np.errstate(over="ignore"):
        up = np.cumprod(np.full(n + 1, _FACTOR, dtype=np.uint64))
        down = np.cumprod(np.full(n + 1, pow(_FACTOR, -1, 1 << 64), dtype=np.uint64))
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mixed(words) * up[:n])])
        return mixed((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64))


def runs(words: np.ndarray, begins: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, run hash, document, start and stop of every run."""
    none = np.zeros(0, dtype=np.int64)
    if len(words) < window:
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    grams = gram_hashes(words, gram)
    anchors = sliding_window_view(grams, window - gram + 1).argmin(axis=1) + np.arange(len(words) - window + 1)
    document = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    at = np.flatnonzero(np.arange(len(anchors)) + window <= begins[document[: len(anchors)] + 1])
    if not len(at):
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    chosen = anchors[at]
    first = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (at[1:] != at[:-1] + 1)]))
    starts = at[first]
    stops = at[np.concatenate([first[1:] - 1, [len(at) - 1]])] + window
    which = document[starts]
    hashes = _span_hashes(words, starts, stops)
    return grams[chosen[first]], hashes, which, starts - begins[which], stops - begins[which]


def _least(keys: tuple[np.ndarray, ...], ids: np.ndarray) -> np.ndarray:
    """Whether a row's id is the smallest among the rows with its keys."""
    order = np.lexsort((ids, *keys[::-1]))
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    smallest = ids[order][new][np.cumsum(new) - 1]
    least = np.empty(len(order), dtype=bool)
    least[order] = ids[order] == smallest
    return least


def _merge(rows: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, ...]:
    """Union of stretches row by row."""
    order = np.lexsort((starts, rows))
    rows, starts, stops = rows[order], starts[order], stops[order]
    reach = np.maximum.accumulate(stops + rows * _FAR)
    new = np.concatenate([[True], (starts + rows * _FAR)[1:] > reach[:-1]]) if len(rows) else np.zeros(0, dtype=bool)
    last = np.flatnonzero(np.concatenate([new[1:], [True]])) if len(rows) else np.zeros(0, dtype=np.int64)
    return rows[new], starts[new], reach[last] - rows[last] * _FAR


def _output(a, r, ids, versions, rows, starts, stops, crowded=None) -> pa.RecordBatch:
    """Rows of the smallest id by anchor and content, and what the others hold as merged, known repeats."""
    mine = ids[rows]
    least = _least((a, r), mine)
    k_rows, k_starts, k_stops = _merge(rows[~least], starts[~least], stops[~least])
    k_hash = mixed(signed(k_rows + k_starts).view(np.uint64) + ids[k_rows].view(np.uint64))
    rows, starts, stops = (np.concatenate(x) for x in ((rows[least], k_rows), (starts[least], k_starts), (stops[least], k_stops)))
    known = np.zeros(len(rows), dtype=bool)
    known[int(least.sum()) :] = True
    busy = np.zeros(len(rows), dtype=bool)
    if crowded is not None and len(crowded):
        at = np.minimum(np.searchsorted(crowded, a[least]), len(crowded) - 1)
        busy[: len(at)] = crowded[at] == a[least]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(signed(np.concatenate([a[least], k_hash]))),
            pa.array(signed(np.concatenate([r[least], k_hash]))),
            pa.array(ids[rows]),
            pa.array(versions[rows]),
            pa.array(starts.astype(np.int32)),
            pa.array(stops.astype(np.int32)),
            pa.array(known),
            pa.array(busy),
        ],
        ["a", "r", "doc_id", "v", "start", "stop", "known", "crowded"],
    )


def _batch_runs(batch: pa.RecordBatch, window: int, gram: int) -> tuple[np.ndarray, ...] | None:
    """Anchor, run, row, start and stop of every run in a batch of ids, versions and texts."""
    texts = batch.column(2).to_pylist()
    parts = []
    for x, y in chunks([len(t or "") // 4 for t in texts], CHUNK_WORDS):
        a, r, rows, starts, stops = runs(*_joined(texts[x:y]), window, gram)
        parts.append((a, r, rows + x, starts, stops))
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True)) if parts else None


def _crowder(window: int, gram: int):
    """Anchors that have several different runs within a batch, and how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _batch_runs(batch, window, gram)
            if found is not None:
                pairs = np.unique(np.stack(found[:2]), axis=1)[0]
                anchors, many = np.unique(pairs, return_counts=True)
                some = many >= SEVERAL
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(anchors[some])), pa.array(many[some])], ["a", "many"]
                )

    return run


def _crowded(chosen: DataFrame, window: int, gram: int) -> np.ndarray:
    """Anchors with very many runs; at most ``MOST_CROWDED``. They decide how rows are dealt, nothing else."""
    tally = chosen.mapInArrow(_crowder(window, gram), "a long, many long")
    tally = written(chosen.sparkSession, tally.groupBy("a").agg(F.sum("many").alias("many")), "anchor-tally")
    total = tally.agg(F.sum("many")).first()[0] or 0
    rows = tally.where(F.col("many") > max(CROWDED, total // MOST_CROWDED)).select("a").collect()
    return np.sort(np.array([r["a"] for r in rows], dtype=np.int64).view(np.uint64))


def _seeder(window: int, gram: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crowded = shared.value
        for batch in batches:
            found = _batch_runs(batch, window, gram)
            if found is not None:
                yield _output(*found[:2], batch.column(0).to_numpy(), batch.column(1).to_numpy(), *found[2:], crowded)

    return run


def _extender(window: int):
    """Windows of the runs that a document's list names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unsure = batch.column(3)
            batch = batch.filter(unsure.is_valid())
            if not batch.num_rows:
                continue
            ids, versions = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            texts, lists = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            parts = []
            for k, (text, wanted) in enumerate(zip(texts, lists, strict=True)):
                grams = gram_hashes(word_hashes(plain_words(text)), window)
                starts = np.array([x["start"] for x in wanted], dtype=np.int64)
                many = np.array([x["stop"] for x in wanted], dtype=np.int64) - window + 1 - starts
                at = np.repeat(starts, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                anchors = np.repeat(np.array([x["a"] for x in wanted], dtype=np.int64), many)
                parts.append((anchors.view(np.uint64), grams[at], np.full(len(at), k), at, at + window))
            a, r, rows, starts, stops = (np.concatenate(c) for c in zip(*parts, strict=True))
            yield _output(a, r, ids, versions, rows, starts, stops)

    return run


def _repeated(found: DataFrame, *dealt: str) -> DataFrame:
    """Rows with ``repeated``: their content also lies in a smaller id."""
    first = F.min("doc_id").over(Window.partitionBy(*dealt, "a", "r"))
    return found.withColumn("repeated", F.col("known") | (F.col("doc_id") > first))


def _judged(found: DataFrame) -> DataFrame:
    """Rows with ``repeated`` and ``open``: not repeated, but other runs have the same anchor.

    Rows are dealt by anchor. Runs of a crowded anchor are open anyway, so these are dealt by content.
    """
    key = F.when(F.col("crowded"), F.xxhash64("a", "r")).otherwise(F.col("a"))
    dealt = _repeated(found.withColumn("k", key).repartition("k"), "k")
    by_key = Window.partitionBy("k")
    return dealt.withColumn("open", F.col("crowded") | (F.min("r").over(by_key) != F.max("r").over(by_key)))


def _lists(rows: DataFrame, keys: list[str], name: str, *columns: str) -> DataFrame:
    return rows.groupBy(F.col("doc_id").alias(keys[0]), F.col("v").alias(keys[1])).agg(
        F.collect_list(F.struct(*columns)).alias(name)
    )


def with_repeats(
    documents: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW, gram: int = GRAM
) -> tuple[DataFrame, str]:
    """The documents with the stretches of words to remove (not merged) in a column whose name comes second."""
    spark = documents.sparkSession
    version = free_name(documents, "_version")
    docs = documents.withColumn(version, F.hash(F.col(f"`{text}`")))
    chosen = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(version).alias("v"), F.col(f"`{text}`").alias("text")
    ).where("doc_id is not null")
    shared = spark.sparkContext.broadcast(_crowded(chosen, window, gram))
    found = _judged(chosen.mapInArrow(_seeder(window, gram, shared), _RUNS)).where("repeated or open")
    found = written(spark, found.select("a", "doc_id", "v", "start", "stop", "repeated"), "repeat-runs")

    name = free_name(docs, "_stretches")
    keys = [free_name(docs, "_list_id"), free_name(docs, "_list_version")]
    unsure = _lists(found.where("not repeated"), keys, name, "a", "start", "stop")

    def joined(lists: DataFrame) -> DataFrame:
        return docs.join(
            lists, (F.col(f"`{doc_id}`").cast("long") == F.col(keys[0])) & (F.col(version) == F.col(keys[1])), "left"
        )

    some = joined(unsure).select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.col(version).alias("v"),
        F.col(f"`{text}`").alias("text"),
        F.col(name),
    )
    windows = _repeated(some.mapInArrow(_extender(window), _RUNS)).where("repeated")
    stretches = found.where("repeated").select("doc_id", "v", "start", "stop").unionByName(
        windows.select("doc_id", "v", "start", "stop")
    )
    frame = joined(_lists(stretches, keys, name, "start", "stop")).drop(*keys, version)
    return frame, name


def maximal(stretches: list[dict] | None) -> list[tuple[int, int]]:
    """Overlapping or adjoining stretches as maximal ones, in order."""
    merged: list[tuple[int, int]] = []
    for start, stop in sorted((x["start"], x["stop"]) for x in stretches or ()):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], stop))
        else:
            merged.append((start, stop))
    return merged


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, removed, digests = [], [], []
        for text, stretches in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            words = plain_words(text)
            kept, at = [], 0
            for start, stop in maximal(stretches):
                kept += words[at:start]
                at = stop
            kept += words[at:]
            counts.append(len(words))
            removed.append(len(words) - len(kept))
            digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_sha256"],
        )


def op2_substring_dedup(documents: DataFrame) -> DataFrame:
    """Words, removed words and digest of the kept ones per document."""
    frame, name = with_repeats(documents.select("doc_id", "text"))
    schema = f"doc_id {dict(documents.dtypes)['doc_id']}, n_words long, n_removed long, kept_sha256 string"
    return frame.select("doc_id", "text", name).mapInArrow(_digest, schema)


def _cut(text: str, stretches: list[dict]) -> str:
    """The text without the words of the stretches and the white space after them."""
    bounds = [m.start() for m in re.finditer(WORD_CLASS, text)] + [len(text)]
    kept, at = [], 0
    for start, stop in maximal(stretches):
        kept.append(text[at : bounds[start]])
        at = bounds[stop]
    return "".join([*kept, text[at:]])


def _cleaner(place: int, names: list[str], mark: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists = batch.column(place).to_pylist(), batch.column(len(names)).to_pylist()
            clean = [_cut(t, s) if t is not None and s else t for t, s in zip(texts, lists, strict=True)]
            arrays = [batch.column(k) for k in range(len(names))]
            arrays[place] = pa.array(clean, type=batch.schema.field(place).type)
            arrays.append(pa.array([bool(s) for s in lists], type=pa.bool_()))
            yield pa.RecordBatch.from_arrays(arrays, [*names, mark])

    return run


def without_repeats(documents: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """The documents with repeated words cut from their text, and the name of a column that says where
    something was cut. Other texts stay as they were."""
    frame, name = with_repeats(documents, text)
    names = documents.columns
    mark = free_name(documents, "_cut")
    schema = T.StructType([*documents.schema.fields, T.StructField(mark, T.BooleanType())])
    cut = frame.select(*(F.col(f"`{c}`") for c in names), F.col(name))
    return cut.mapInArrow(_cleaner(names.index(text), names, mark), schema), mark
