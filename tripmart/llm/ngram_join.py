"""N-gram Jaccard join by parity sketches.

A document's set holds its distinct shingles (of four words unless told otherwise). Every shingle flips one bit of a sketch of
``P`` parts, so two sketches differ in at most as many bits as the sets have shingles not in common,
and a similarity of at least t bounds that number by d = (1 - t) / (1 + t) times the sum of the two
sizes. Of P > d parts at least P - d then agree in full. Documents meet at equal parts:

* P is fixed per band of sizes (a band spans a factor of two); a document also takes part in the
  band below if partners may lie there.
* Of a document's parts only the d + 1 best are used: those that aren't crowded (which all documents'
  parts are counted for), of many bits, and then by a hash of their content. Equal parts rank alike
  in both documents, so whichever of the two leaves out more, one of the agreeing parts is left.

Equal sets become one class first. At each part, all members are compared with the first one
(stars), candidates pass a test of sizes and of the Hamming distance of short sketches, and their
shingles are compared exactly. Where a part then still joins different components, members of
these are tested in the join itself, and what passes is compared too. So no link is lost, while a group of near copies costs a star.

Words are split at white space and A-Z is lower-cased. With fewer words than a shingle the whole
sequence is the only one. Null, empty and blank texts have an empty set and are linked with nothing. Rows
of the same id are one document: the links of any of them are its links. A null id is never linked
and is its own component. An empty table gives an empty result. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import folded_words, free_name, gram_hashes, mixed, signed, word_hashes
from tripmart.llm.components import components
from tripmart.workspace import written

SHINGLE = 4
#: Two documents are linked if 100 * intersection >= PERCENT * union.
PERCENT = 85
PART_BITS = 1 << 10
SKETCH_BITS = 1024
CROWDED = 32
MOST_CROWDED = 20_000


def shingle_hashes(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of a text's shingles, in order."""
    words = word_hashes(folded_words(text))
    if 0 < len(words) < size:
        return gram_hashes(words, len(words)) + np.uint64(len(words))
    return np.unique(gram_hashes(words, size))


def shingle_set(text: str | None, size: int = SHINGLE) -> set[bytes]:
    words = folded_words(text)
    if 0 < len(words) < size:
        return {b" ".join(words)}
    return {b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)}


def most_apart(n: int, m: int, percent: int) -> int:
    """How many shingles may not be in common in linked sets of these sizes."""
    return (100 - percent) * (n + m) // (100 + percent)


def _parts_of(band: int, percent: int) -> int:
    """Parts of a band's sketches; the band holds sizes from 2**band to 2**(band + 1) - 1."""
    top = (2 << band) - 1
    return (most_apart(top, top * 100 // percent, percent) + 1) * 13 // 10


def _band_parts(hashes: np.ndarray, band: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Content hash and number of bits of every part of a set's sketch in a band."""
    many = _parts_of(band, percent)
    h = mixed(hashes ^ np.uint64(band + 1))
    part = ((h >> np.uint64(32)) * np.uint64(many)) >> np.uint64(32)
    cells, counts = np.unique(part * np.uint64(PART_BITS) + (h & np.uint64(PART_BITS - 1)), return_counts=True)
    cells = cells[counts & 1 == 1]
    of = (cells // np.uint64(PART_BITS)).astype(np.int64)
    bits = np.bincount(of, minlength=many)
    content = np.zeros(many, dtype=np.uint64)
    if len(cells):
        first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        content[of[first]] = np.bitwise_xor.reduceat(mixed(cells + np.uint64(1)), first)
    return mixed(content ^ mixed(np.arange(many, dtype=np.uint64) + np.uint64(band << 40))), bits


def _best(content: np.ndarray, bits: np.ndarray, apart: int, crowded: np.ndarray | None) -> np.ndarray:
    """The ``apart + 1`` best parts: those few documents have, of many bits, then by content.

    Without the table of crowded parts, all parts.
    """
    if crowded is None or apart + 1 >= len(content):
        return content
    at = np.minimum(np.searchsorted(crowded, content), max(len(crowded) - 1, 0))
    rare = crowded[at] != content if len(crowded) else np.ones(len(content), dtype=bool)
    return content[np.lexsort((content, bits, rare))[len(content) - apart - 1 :]]


def sketch_keys(hashes: np.ndarray, percent: int = PERCENT, crowded: np.ndarray | None = None) -> np.ndarray:
    """All keys at which a set with partners of any size must meet them."""
    n = len(hashes)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    band = n.bit_length() - 1
    keys = [_best(*_band_parts(hashes, band, percent), most_apart(n, n * 100 // percent, percent), crowded)]
    below = (1 << band) - 1
    if below and 100 * below >= percent * n:
        keys.append(_best(*_band_parts(hashes, band - 1, percent), most_apart(n, below, percent), crowded))
    return np.concatenate(keys)


def short_sketch(hashes: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """A parity sketch of few bits as signed 64-bit words."""
    flips = np.bincount((mixed(hashes) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8)).view(np.int64)


def _class_of(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def _members(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(t, size) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(h) for h in sets], type=pa.int64()),
                    pa.array([_class_of(h) for h in sets], type=pa.binary()),
                ],
                ["doc_id", "n", "class"],
            )

    return run


def _keys(percent: int, size: int, shared=None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crowded = None if shared is None else shared.value
        for batch in batches:
            first: dict[bytes, tuple[int, np.ndarray]] = {}
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                hashes = shingle_hashes(text, size)
                if len(hashes):
                    kind = _class_of(hashes)
                    if kind not in first:
                        first[kind] = (doc_id, sketch_keys(hashes, percent, crowded))
                    elif doc_id < first[kind][0]:
                        first[kind] = (doc_id, first[kind][1])
            ids = np.array([x[0] for x in first.values()], dtype=np.int64)
            keys = [x[1] for x in first.values()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(np.concatenate(keys)) if keys else [], type=pa.int64()),
                    pa.array(np.repeat(ids, [len(k) for k in keys]), type=pa.int64()),
                ],
                ["key", "id"],
            )

    return run


def _texts(size: int):
    """Size and short sketch beside each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(t, size) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(h) for h in sets], type=pa.int64()),
                    pa.array([short_sketch(h).tolist() for h in sets], type=pa.list_(pa.int64())),
                    batch.column(1),
                ],
                ["id", "n", "sketch", "text"],
            )

    return run


def _linked(percent: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_text, kept = None, set()
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                text = x.as_py()
                if text != kept_text:
                    kept_text, kept = text, shingle_set(text, size)
                other = shingle_set(y.as_py(), size)
                common = len(kept & other)
                good.append(100 * common >= percent * (len(kept) + len(other) - common))
            mask = pa.array(good, type=pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(mask), batch.column(1).filter(mask)], ["x", "y"]
            )

    return run


def _may_link(x: str, y: str, percent: int) -> Column:
    """Whether the sizes and the Hamming distance of the short sketches allow a link."""
    n_x, n_y = F.col(f"{x}_n"), F.col(f"{y}_n")
    words = SKETCH_BITS // 64
    distance = sum(
        (F.bit_count(F.get(f"{x}_sketch", F.lit(i)).bitwiseXOR(F.get(f"{y}_sketch", F.lit(i)))) for i in range(words)),
        F.lit(0),
    )
    sizes = F.lit(100) * F.least(n_x, n_y) >= F.lit(percent) * F.greatest(n_x, n_y)
    return sizes & (F.lit(100 + percent) * distance <= F.lit(100 - percent) * (n_x + n_y))


def _figures(texts: DataFrame, name: str) -> DataFrame:
    return texts.select(F.col("id").alias(name), F.col("n").alias(f"{name}_n"), F.col("sketch").alias(f"{name}_sketch"))


def _verified(spark: SparkSession, near: DataFrame, texts: DataFrame, percent: int, size: int) -> DataFrame:
    """Of candidate pairs ``x < y``, those that are linked."""
    near = written(spark, near.distinct(), "near-pairs")
    with_x = near.join(texts.select(F.col("id").alias("x"), F.col("text").alias("text_x")), "x")
    with_xy = with_x.join(texts.select(F.col("id").alias("y"), F.col("text").alias("text_y")), "y")
    return with_xy.select("x", "y", "text_x", "text_y").mapInArrow(_linked(percent, size), "x long, y long")


def _ordered(frame: DataFrame, a: str, b: str) -> DataFrame:
    return frame.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("x"), F.greatest(a, b).alias("y")).distinct()


def _crowded(shared: DataFrame) -> np.ndarray:
    """Parts that very many documents have: at least ``CROWDED`` and so many that at most ``MOST_CROWDED``
    parts can be. Documents use them last, if at all; they cost candidates, never links."""
    total = shared.agg(F.sum("many")).first()[0] or 0
    rows = shared.where(F.col("many") > max(CROWDED, total // MOST_CROWDED)).select("key").collect()
    return np.sort(np.array([r["key"] for r in rows], dtype=np.int64).view(np.uint64))


def joined(documents: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``doc_id, text``."""
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    named = docs.where("doc_id is not null")

    members = written(spark, docs.mapInArrow(_members(size), "doc_id long, n long, class binary"), "set-classes")
    worded = members.where("n > 0 and doc_id is not null")
    firsts = written(spark, worded.groupBy("class").agg(F.min("doc_id").alias("first")), "set-firsts")
    of_class = written(spark, worded.join(firsts, "class").select("doc_id", "first").distinct(), "set-members")

    parts = named.mapInArrow(_keys(percent, size), "key long, id long")
    shared = parts.groupBy("key").agg(
        F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("many")
    )
    shared = written(spark, shared.where("low < high").select("key", "low", "many"), "shared-parts")
    crowded = spark.sparkContext.broadcast(_crowded(shared))
    best = named.mapInArrow(_keys(percent, size, crowded), "key long, id long")
    meetings = written(spark, best.join(shared, "key").select("key", "id", "low"), "meetings")

    met = meetings.select("id").union(meetings.select("low")).distinct()
    met = met.join(of_class, F.col("id") == F.col("doc_id"))
    met = written(spark, met.select(F.col("first").alias("doc_id")).distinct(), "met")
    texts = named.join(met, "doc_id", "left_semi").mapInArrow(
        _texts(size), "id long, n long, sketch array<long>, text string"
    )
    texts = written(spark, texts, "met-texts")

    def firsts_of(frame: DataFrame, column: str) -> DataFrame:
        one = of_class.select(F.col("doc_id").alias(column), F.col("first").alias(f"{column}_first"))
        return frame.join(one, column)

    stars = written(spark, meetings.where("id > low").select("id", "low").distinct(), "stars")
    stars = written(spark, _ordered(firsts_of(firsts_of(stars, "id"), "low"), "id_first", "low_first"), "stars")
    near = stars.join(_figures(texts, "x"), "x").join(_figures(texts, "y"), "y").where(_may_link("x", "y", percent))
    links = written(spark, _verified(spark, near.select("x", "y"), texts, percent, size), "links")

    same = of_class.where("doc_id != first").select(F.col("first").alias("x"), F.col("doc_id").alias("y"))
    several = same.groupBy("y").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("y")
    bridges = written(spark, same.join(several, "y"), "bridges")
    roots = written(spark, components(spark, links.union(bridges)), "roots")

    placed = firsts_of(meetings.select("key", "id"), "id").select("key", F.col("id_first").alias("node")).distinct()
    placed = placed.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    placed = written(spark, placed, "placed")
    split = placed.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b").select("key")
    split = written(spark, split, "split-parts")
    open_ = placed.join(split, "key").join(_figures(texts, "node"), "node")
    open_ = written(spark, open_, "open-parts")
    left, right = (
        open_.select(
            "key",
            F.col("node").alias(c),
            F.col("root").alias(f"{c}_root"),
            F.col("node_n").alias(f"{c}_n"),
            F.col("node_sketch").alias(f"{c}_sketch"),
        )
        for c in "ab"
    )
    across = left.join(right, (left["key"] == right["key"]) & (F.col("a_root") < F.col("b_root")) & _may_link("a", "b", percent))
    across = _ordered(across, "a", "b").join(stars, ["x", "y"], "left_anti")
    more = written(spark, _verified(spark, across, texts, percent, size), "more-links")

    merged = roots.select(F.col("node").alias("x"), F.col("root").alias("y")).union(more)
    final = written(spark, components(spark, merged), "final-roots")
    to_root = of_class.join(final, F.col("first") == F.col("node"), "left").select(
        "doc_id", F.least(F.col("first"), F.coalesce("root", "first")).alias("root")
    )
    to_root = written(spark, to_root.groupBy("doc_id").agg(F.min("root").alias("root")), "component-of")
    return members.join(to_root, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "doc_id").alias("component_id")
    )


def op9_ngram_join(documents: DataFrame) -> DataFrame:
    """Set size and component of every document."""
    return joined(documents)


def one_of_each(documents: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """The rows of the smallest id of each component, as they came; null ids stay."""
    name = free_name(documents, "_kept_id")
    kept = joined(documents, percent, size).where("doc_id is null or doc_id = component_id")
    kept = kept.select(F.col("doc_id").alias(name)).distinct()
    return documents.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col(name)), "left_semi")
