"""Fill-in-the-middle transformation by displacement scatter, and its inverse.

A text is a sequence of units: runs of ASCII letters, and single other characters. Two cuts, drawn
from a hash of the document's id, part it into prefix, middle and suffix, which are written with
markers in one of two orders:

* ``psm``: prefix marker, prefix, suffix marker, suffix, middle marker, middle;
* ``spm``: suffix marker, suffix, prefix marker, prefix, middle marker, middle;

or it stays as it is (``plain``): a share of the texts, empty ones, and those that hold a marker.

Many texts are turned at once as one array of bytes. A scan finds the units and with them the cuts.
Every part moves by a distance of its own; a difference array holds the changes of that distance at
the parts' first bytes, its cumulative sum is every byte's shift, and one scatter puts all bytes in
their places. The inverse has nothing but outputs and forms: the markers in them bound the parts, and a
gather along shifts made the same way gives the texts again. No marker may overlap another
or itself, so what lies beside a marker can't be taken for one.

Null texts are empty. A null id hashes as an empty one. Repeated rows are each turned, alike; an empty table
gives an empty result; columns other than the id and the text aren't read. An output that no text has
(markers missing or doubled) is restored as null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import chunks, free_name, text_bytes, text_column

#: Texts are turned in groups of about so many bytes; a longer text is a group of its own.
GROUP_BYTES = 1 << 20

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True

_TURNED = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


@dataclass(frozen=True)
class Rules:
    """Shares in percent, the seed of the cuts, and the markers of prefix, suffix and middle."""

    turned: int = 90
    suffix_first: int = 20
    seed: str = "1"
    markers: tuple[str, str, str] = ("<P>", "<S>", "<M>")

    def __post_init__(self):
        for i, a in enumerate(self.markers):
            for j, b in enumerate(self.markers):
                if not a or (a in b and i != j) or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)))):
                    raise ValueError(f"markers {a!r} and {b!r} could be taken for each other")

    @property
    def encoded(self) -> list[np.ndarray]:
        return [np.frombuffer(m.encode(), dtype=np.uint8) for m in self.markers]


def draws(seed: str, ids: list[int | None]) -> np.ndarray:
    """Four numbers of 32 bits for each id."""
    digests = (hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(b"".join(digests), dtype=">u4").astype(np.int64).reshape(-1, 4)


def places_of(marker: np.ndarray, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where a marker lies in the bytes, within one text; ``ends`` has the end of each byte's text."""
    n = len(data) - len(marker) + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    hit = data[:n] == marker[0]
    for j in range(1, len(marker)):
        hit &= data[j : j + n] == marker[j]
    found = np.flatnonzero(hit)
    return found[found + len(marker) <= ends[np.minimum(found, len(data) - 1)]]


def shifts(begins: np.ndarray, moves: np.ndarray, n: int) -> np.ndarray:
    """Every byte's distance, from the first bytes of consecutive parts (which may be empty) and their distances."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, begins, np.diff(moves, prepend=0))
    return np.cumsum(change[:n])


def parted(data: np.ndarray, begins: np.ndarray, drawn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of units of each text, and where prefix, middle and suffix begin and the text ends (4 columns)."""
    first, last = begins[:-1], begins[1:]
    letter = _LETTER[data]
    joined = np.zeros(len(data), dtype=bool)
    joined[1:] = letter[1:] & letter[:-1]
    joined[first[first < last]] = False
    units = np.flatnonzero(~joined & (data & 0xC0 != 0x80))
    base = np.searchsorted(units, first)
    n = np.searchsorted(units, last) - base
    cut = np.sort(drawn[:, :2] % (n + 1)[:, None], axis=1)
    places = np.append(units, len(data))[np.minimum(base[:, None] + cut, len(units))]
    places = np.where(cut < n[:, None], places, last[:, None])
    return n, np.column_stack((first, places, last))


def turn(data: np.ndarray, begins: np.ndarray, ids: list[int | None], rules: Rules) -> dict[str, pa.Array]:
    """Outputs of texts, with their forms and figures."""
    drawn = draws(rules.seed, ids)
    n, bounds = parted(data, begins, drawn)
    sizes = np.diff(begins)
    markers = rules.encoded
    held = np.zeros(len(ids), dtype=bool)
    ends = np.repeat(begins[1:], sizes)
    for m in markers:
        held[np.searchsorted(begins, places_of(m, data, ends), side="right") - 1] = True
    plain = held | (sizes == 0) | (drawn[:, 2] % 100 >= rules.turned)
    spm = ~plain & (drawn[:, 3] % 100 < rules.suffix_first)

    prefix, middle, suffix = np.diff(bounds, axis=1).T
    lengths = [len(m) for m in markers]
    out_begins = np.concatenate(([0], np.cumsum(sizes + np.where(plain, 0, sum(lengths)))))
    at = out_begins[:-1]
    # Where the markers of prefix, suffix and middle come to lie.
    prefix_at = np.where(spm, at + lengths[1] + suffix, at)
    suffix_at = np.where(spm, at, at + lengths[0] + prefix)
    middle_at = at + lengths[0] + prefix + lengths[1] + suffix
    to = np.column_stack((prefix_at + lengths[0], middle_at + lengths[2], suffix_at + lengths[1]))
    to = np.where(plain[:, None], at[:, None] + bounds[:, :3] - bounds[:, :1], to)

    output = np.zeros(out_begins[-1], dtype=np.uint8)
    output[np.arange(len(data)) + shifts(bounds[:, :3].ravel(), (to - bounds[:, :3]).ravel(), len(data))] = data
    for m, places in zip(markers, (prefix_at, suffix_at, middle_at), strict=True):
        for j, byte in enumerate(m):
            output[places[~plain] + j] = byte

    chars = np.concatenate(([0], np.cumsum(data & 0xC0 != 0x80)))[bounds]
    counted = np.diff(chars, axis=1)
    form = np.where(plain, "plain", np.where(spm, "spm", "psm"))
    return {
        "n": pa.array(n, type=pa.int64()),
        "form": pa.array(form.tolist(), type=pa.string()),
        "prefix_chars": pa.array(counted[:, 0], type=pa.int64(), mask=plain),
        "middle_chars": pa.array(counted[:, 1], type=pa.int64(), mask=plain),
        "output": text_column(output, out_begins),
    }


def undo(data: np.ndarray, begins: np.ndarray, forms: list[str | None], rules: Rules) -> pa.Array:
    """The texts of outputs, from these and their forms alone; null where an output can't have come about."""
    first, last = begins[:-1], begins[1:]
    markers = rules.encoded
    lengths = [len(m) for m in markers]
    form = np.array([f or "" for f in forms], dtype=object)
    spm, plain = form == "spm", form == "plain"
    ends = np.repeat(last, last - first)
    found, single = [], np.ones(len(forms), dtype=bool)
    for m in markers:
        places = places_of(m, data, ends)
        row = np.searchsorted(begins, places, side="right") - 1
        single &= np.bincount(row, minlength=len(forms)) == 1
        place = np.zeros(len(forms), dtype=np.int64)
        place[row] = places
        found.append(place)
    p, s, m = found
    ordered = np.where(spm, (s == first) & (s + lengths[1] <= p), (p == first) & (p + lengths[0] <= s))
    ordered &= np.where(spm, p + lengths[0] <= m, s + lengths[1] <= m)
    sound = plain | (single & ordered & (spm | (form == "psm")))

    begin = np.column_stack((p + lengths[0], m + lengths[2], s + lengths[1]))
    end = np.column_stack((np.where(spm, m, s), last, np.where(spm, p, m)))
    begin = np.where(plain[:, None], np.column_stack((first, last, last)), begin)
    end = np.where(plain[:, None], last[:, None], end)
    sizes = np.where(sound[:, None], end - begin, 0)
    to = np.cumsum(np.concatenate(([0], sizes.ravel())))
    total = int(to[-1])
    source = np.arange(total) + shifts(to[:-1], np.where(sound[:, None], begin, 0).ravel() - to[:-1], total)
    texts = text_column(data[source], np.append(to[:-1:3], total))
    return pc.if_else(pa.array(sound), texts, pa.scalar(None, type=pa.string()))


def _groups(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch whose texts are about a group's size, with the texts' bytes."""
    data, begins = text_bytes(batch.column(column))
    for a, b in chunks(np.diff(begins).tolist(), GROUP_BYTES):
        yield batch.slice(a, b - a), data[begins[a] : begins[b]], begins[a : b + 1] - begins[a]


def _turner(rules: Rules):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, begins in _groups(batch, 1):
                columns = {"doc_id": part.column(0)} | turn(data, begins, part.column(0).to_pylist(), rules)
                yield pa.RecordBatch.from_pydict(columns)

    return run


def _undoer(rules: Rules, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, begins in _groups(batch, batch.num_columns - 1):
                texts = undo(data, begins, part.column(part.num_columns - 2).to_pylist(), rules)
                yield pa.RecordBatch.from_arrays([*part.columns[:-2], texts], names)

    return run


def fill_in_middle(documents: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Every text turned: ``doc_id, n`` (units), ``form, prefix_chars, middle_chars`` (null if plain), ``output``."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_turner(rules), _TURNED)


def restored(outputs: DataFrame, name: str = "restored", rules: Rules = Rules()) -> DataFrame:
    """The rows of ``outputs`` with the texts that ``output`` and ``form`` came from, in a column named
    ``name`` (with underscores before it if there is one already)."""
    form, output = free_name(outputs, "form_"), free_name(outputs, "output_")
    kept = outputs.select("*", F.col("form").alias(form), F.col("output").alias(output))
    schema = outputs.withColumn(free_name(outputs, name), F.col("output").cast("string")).schema
    return kept.mapInArrow(_undoer(rules, schema.names), schema)


def op12_fill_in_middle(documents: DataFrame) -> DataFrame:
    """Turn every text, restore it from the output and report both by digest."""
    back = restored(fill_in_middle(documents))
    return back.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )
