"""Benchmark decontamination with suffix arrays over shards of the training documents.

Every task cuts its documents into shards of about a million words, sorts each shard's word
suffixes, and looks up every suffix of every benchmark item by binary search, one more word at a
time. The interval of training suffixes that is left gives all places of a match, and the last
intervals, deeper over shallower, give each place its longest verbatim match, and so each document's. Documents never leave their task:
there is no shuffle, and a passage that a third of all documents share costs no more than its
places. The benchmark is the query set: its word hashes go to the tasks in blocks of bounded
size, one pass-through step per block. Matches of one word alone aren't reported as longest.

A window is 13 consecutive words of an item; an item with fewer words, but not none, is one
window. Words of a document inside any occurrence of a window are hit.

Null and empty texts have no words and are never contaminated; items without words match
nothing; rows of the same item id count as one item. Repeated documents are judged one by one.
An empty table gives an empty result. Other columns, whatever their names, stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm.common import chunks, free_name, terms, word_hashes

WINDOW = 13
SHARD_WORDS = 1 << 20
BLOCK_BYTES = 32 << 20
#: A document is contaminated if at least one in so many of its words is hit.
ONE_IN = 20

_HITS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())]))
_LONGEST = T.StructType(
    [
        T.StructField("length", T.IntegerType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("item_start", T.IntegerType()),
    ]
)
_ADDED = (
    ("n_words", T.LongType(), pa.int64()),
    ("hits", _HITS, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
    ("items", T.ArrayType(T.StringType()), pa.list_(pa.string())),
    (
        "longest",
        _LONGEST,
        pa.struct([("length", pa.int32()), ("start", pa.int32()), ("item_id", pa.string()), ("item_start", pa.int32())]),
    ),
)


class SuffixArray:
    """Word suffixes of a shard in order, as far as ``depth`` words tell them apart."""

    def __init__(self, documents: list[np.ndarray], depth: int):
        sizes = np.array([len(d) for d in documents], dtype=np.int64)
        self.begins = np.concatenate([[0], np.cumsum(sizes + 1)])
        self.size = int(self.begins[-1])
        end = np.zeros(1, dtype=np.uint64)
        joined = np.concatenate([x for d in documents for x in (d, end)]) if documents else end[:0]
        ends = self.begins[1:] - 1
        self.vocabulary, places = np.unique(joined, return_inverse=True)
        self.words = places.astype(np.int64) + 1
        self.words[ends] = 0
        self._sort(depth)

    def _sort(self, depth: int) -> None:
        """Doubling: of suffixes that agree in ``h`` words, order those that still tie by the next ``h``."""
        n = self.size
        order = np.argsort(self.words, kind="stable")
        rank = np.empty(n + 1, dtype=np.int64)
        rank[n] = -1
        slots = np.arange(n)
        rank[order] = self._group_starts(self.words[order], slots)
        h = 1
        while h < depth:
            starts = rank[order]
            tied = np.zeros(n, dtype=bool)
            same = starts[1:] == starts[:-1]
            tied[1:] |= same
            tied[:-1] |= same
            tied &= self.words[order] > 0
            slots = np.flatnonzero(tied)
            if not len(slots):
                break
            members = order[slots]
            key = rank[members] * (n + 2) + rank[np.minimum(members + h, n)] + 1
            by_key = np.argsort(key, kind="stable")
            members, key = members[by_key], key[by_key]
            order[slots] = members
            rank[members] = self._group_starts(key, slots)
            h *= 2
        self.order = order

    @staticmethod
    def _group_starts(key: np.ndarray, slots: np.ndarray) -> np.ndarray:
        first = np.ones(len(key), dtype=bool)
        first[1:] = key[1:] != key[:-1]
        return np.maximum.accumulate(np.where(first, slots, 0)) if len(key) else slots[:0]

    def ranks(self, hashes: np.ndarray) -> np.ndarray:
        """The shard's numbers for words, -1 for words that it doesn't have."""
        at = np.searchsorted(self.vocabulary, hashes)
        at = np.minimum(at, len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, -1)

    def _bound(self, low: np.ndarray, high: np.ndarray, word: np.ndarray, j: int, right: bool) -> np.ndarray:
        low, high = low.copy(), high.copy()
        while True:
            open_ = low < high
            if not open_.any():
                return low
            mid = (low + high) >> 1
            at = self.words[np.minimum(self.order[np.minimum(mid, self.size - 1)] + j, self.size - 1)]
            up = (at <= word) if right else (at < word)
            low = np.where(open_ & up, mid + 1, low)
            high = np.where(open_ & ~up, mid, high)

    def search(self, query: np.ndarray, begins: np.ndarray, ends: np.ndarray, need: np.ndarray):
        """For each query suffix ``query[begins:ends]`` its interval at ``need`` words; for each place of the shard
        how many words from there on match a query suffix (0 for fewer than two), and which one."""
        many = len(begins)
        found = np.zeros((many, 2), dtype=np.int64)
        length = np.zeros(self.size, dtype=np.int64)
        suffix = np.full(self.size, -1, dtype=np.int64)
        alive = np.arange(many)
        low = np.zeros(many, dtype=np.int64)
        high = np.full(many, self.size, dtype=np.int64)
        j = 0
        while len(alive):
            go = begins[alive] + j < ends[alive]
            alive, low, high = alive[go], low[go], high[go]
            word = query[begins[alive] + j] if len(alive) else query[:0]
            known = word > 0
            alive, low, high, word = alive[known], low[known], high[known], word[known]
            if not len(alive):
                break
            first = self._bound(low, high, word, j, right=False)
            last = self._bound(first, high, word, j, right=True)
            some = first < last
            alive, low, high = alive[some], first[some], last[some]
            j += 1
            if j > 1:
                # Intervals of one depth are equal or apart.
                lows, firsts = np.unique(low, return_index=True)
                counts = high[firsts] - lows
                shifts = np.repeat(lows - (np.cumsum(counts) - counts), counts)
                where = self.order[np.arange(len(shifts)) + shifts]
                length[where] = j
                suffix[where] = np.repeat(alive[firsts], counts)
            enough = need[alive] == j
            found[alive[enough], 0] = low[enough]
            found[alive[enough], 1] = high[enough]
        return found, length, suffix


class Benchmark:
    """Word hashes of the items of one block, and the bounds of all their suffixes."""

    def __init__(self, items: list[tuple[str, np.ndarray]], window: int):
        items = sorted((x for x in items if len(x[1])), key=lambda x: (x[0], len(x[1])))
        self.ids = [x[0] for x in items]
        self.words = np.concatenate([x[1] for x in items]) if items else np.zeros(0, dtype=np.uint64)
        sizes = np.array([len(x[1]) for x in items], dtype=np.int64)
        stops = np.cumsum(sizes)
        self.item = np.repeat(np.arange(len(items)), sizes)
        self.begins = np.arange(len(self.words))
        self.ends = stops[self.item] if len(items) else self.begins
        self.firsts = (stops - sizes)[self.item] if len(items) else self.begins
        whole = (sizes < window)[self.item] & (self.begins == self.firsts) if len(items) else self.begins > 0
        left = self.ends - self.begins
        self.need = np.where(left >= window, window, np.where(whole, left, -1))
        self.depth = int(sizes.max()) if len(items) else 1


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], stop))
        else:
            merged.append((start, stop))
    return merged


def _search_shard(documents: list[np.ndarray], bench: Benchmark) -> list[tuple[list, set, tuple | None]]:
    """Hit spans, items and longest match of each document."""
    results: list[tuple[list, set, tuple | None]] = [([], set(), None) for _ in documents]
    if not len(bench.words) or not any(len(d) for d in documents):
        return results
    array = SuffixArray(documents, bench.depth)
    found, length, suffix = array.search(array.ranks(bench.words), bench.begins, bench.ends, bench.need)
    hit = np.flatnonzero(found[:, 1] > found[:, 0])
    if len(hit):
        counts = found[hit, 1] - found[hit, 0]
        query = np.repeat(hit, counts)
        offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        where = array.order[found[query, 0] + offset]
        edge = np.zeros(array.size + 1, dtype=np.int64)
        np.add.at(edge, where, 1)
        np.add.at(edge, where + bench.need[query], -1)
        covered = np.concatenate([[False], np.cumsum(edge[:-1]) > 0, [False]])
        starts = np.flatnonzero(covered[1:] & ~covered[:-1])
        stops = np.flatnonzero(~covered[1:] & covered[:-1])
        of = np.searchsorted(array.begins, starts, side="right") - 1
        for d, a, b in zip(of.tolist(), starts.tolist(), stops.tolist(), strict=True):
            base = int(array.begins[d])
            results[d][0].append((a - base, b - base))
        pairs = np.unique(
            np.stack([np.searchsorted(array.begins, where, side="right") - 1, bench.item[query]]), axis=1
        )
        for d, i in pairs.T.tolist():
            results[d][1].add(bench.ids[i])
    best: dict[int, tuple] = {}
    most = np.maximum.reduceat(length, array.begins[:-1])
    places = np.flatnonzero((length > 0) & (length == np.repeat(most, np.diff(array.begins))))
    of, firsts = np.unique(np.searchsorted(array.begins, places, side="right") - 1, return_index=True)
    for d, at in zip(of.tolist(), places[firsts].tolist(), strict=True):
        q = int(suffix[at])
        start = int(at - array.begins[d])
        best[d] = (int(length[at]), start, bench.ids[bench.item[q]], int(bench.begins[q] - bench.firsts[q]))
    return [(s, i, best.get(d)) for d, (s, i, _) in enumerate(results)]


def _longer(a: tuple | None, b: tuple | None) -> tuple | None:
    """The longer match, of equal ones the earlier in the document."""
    return min((x for x in (a, b) if x), key=lambda x: (-x[0], *x[1:]), default=None)


def _step(names: dict[str, str], text: str, shared, fresh: bool, shard_words: int):
    """A pass over Arrow batches that adds what one block of the benchmark finds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench = shared.value
        for batch in batches:
            table = pa.Table.from_batches([batch])
            hashes = [word_hashes(terms(x)) for x in table.column(text).to_pylist()]
            out: list[tuple[list, set, tuple | None]] = []
            for a, b in chunks([len(h) for h in hashes], shard_words):
                out += _search_shard(hashes[a:b], bench)
            if not fresh:
                before = [table.column(names[k]).to_pylist() for k in ("hits", "items", "longest")]
                out = [
                    (
                        _union([*s, *((x["start"], x["stop"]) for x in s0)]),
                        i | set(i0),
                        _longer(m, tuple(m0.values()) if m0 else None),
                    )
                    for (s, i, m), s0, i0, m0 in zip(out, *before, strict=True)
                ]
            values = {
                "n_words": [len(h) for h in hashes],
                "hits": [[{"start": a, "stop": b} for a, b in s] for s, _, _ in out],
                "items": [sorted(i) for _, i, _ in out],
                "longest": [
                    dict(zip(("length", "start", "item_id", "item_start"), m, strict=True)) if m else None
                    for _, _, m in out
                ],
            }
            for key, _, kind in _ADDED:
                column = pa.array(values[key], type=kind)
                if fresh:
                    table = table.append_column(names[key], column)
                else:
                    table = table.set_column(table.column_names.index(names[key]), names[key], column)
            yield from table.combine_chunks().to_batches()

    return run


def matches(
    documents: DataFrame,
    items: DataFrame,
    text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    shard_words: int = SHARD_WORDS,
) -> tuple[DataFrame, dict[str, str]]:
    """The documents with ``n_words``, hit spans, ids of occurring items and the longest verbatim
    match (of equal ones the first), in columns whose names come second."""
    spark = documents.sparkSession
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    names: dict[str, str] = {}
    frame, schema = documents, T.StructType(list(documents.schema.fields))
    for key, kind, _ in _ADDED:
        names[key] = free_name(frame, key)
        schema = schema.add(names[key], kind)
    chosen = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    for b in range(blocks):
        mine = chosen.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b) if blocks > 1 else chosen
        rows = [(r["item_id"], word_hashes(terms(r["text"]))) for r in mine.toLocalIterator()]
        shared = spark.sparkContext.broadcast(Benchmark(rows, window))
        frame = frame.mapInArrow(_step(names, text, shared, b == 0, shard_words), schema)
    return frame, names


def _verdict(n_words: str, hits: str):
    n_hit = F.aggregate(
        F.col(f"`{hits}`"), F.lit(0).cast("long"), lambda s, x: s + (x["stop"] - x["start"]).cast("long")
    )
    return n_hit, (n_hit > 0) & (F.lit(ONE_IN) * n_hit >= F.col(f"`{n_words}`"))


def op3_decontamination(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Words, hit words, occurring items and verdict per document."""
    found, names = matches(documents.select("doc_id", "text"), items)
    n_hit, contaminated = _verdict(names["n_words"], names["hits"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated.alias("contaminated"),
    )


def clean_documents(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of the documents that aren't contaminated, as they came."""
    found, names = matches(documents, items)
    _, contaminated = _verdict(names["n_words"], names["hits"])
    return found.where(~contaminated).select(*(F.col(f"`{c}`") for c in documents.columns))

