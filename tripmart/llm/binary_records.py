"""Length-delimited binary records of token sequences, with a separate offset index.

A record is: its payload's length (8 bytes), the masked checksum of these bytes (4), the payload,
the masked checksum of the payload (4), all little-endian. The checksum is CRC-32; masking rotates
it by 15 bits and adds a constant, so that a checksum over data that holds checksums stays sound.
A payload is a flag byte (1: the id is null), the document's id (8 bytes) and the token ids, of
two bytes if the vocabulary allows it, else of four. A file begins with a record that names the
format and the width. Beside each file lies its index: a fixed-size entry per record with id, offset,
length and number of tokens, so records can be fetched in any order without reading the file.

Files hold ranges of ids in ascending order: the table is dealt by range once, and each task writes
one file under a name of its own. A file counts only if the manifest lists it, which Spark commits
when all tasks are done; what a lost or repeated task left behind is never read.

A null text is empty and has the end id alone. Null ids come first. Rows of the same id are all
written, ordered by their text. An empty table gives no file and an empty result. Columns other
than the id and the text aren't written.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.tokens import encoder, file_of
from tripmart.workspace import fresh_path, written

# The rotation and the constant of masked checksums.
ROTATION = 15
MASK_ADDED = 0xA282EAD8

HEAD = "<QI"
TAIL = "<I"
KEY = "<Bq"
ENTRY = "<BqQQQ"
CHUNK_BYTES = 8 << 20

_MANIFEST = "file string, index string, n_records long, n_tokens long, first_null boolean, first_id long"
_RECORD = "file string, doc_id long, place long, n_tokens long, ids_crc32 long"
_INDEX = "file string, doc_id long, offset long, length long, n_tokens long"
_FETCHED = "file string, offset long, doc_id long, ids array<long>"


class DamagedRecord(ValueError):
    pass


def masked_checksum(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> ROTATION | crc << (32 - ROTATION)) + MASK_ADDED) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join(
        (length, struct.pack(TAIL, masked_checksum(length)), payload, struct.pack(TAIL, masked_checksum(payload)))
    )


def _exact(stream, size: int) -> bytes:
    data = stream.read(size)
    if len(data) != size:
        raise DamagedRecord("the file ends within a record")
    return data


def unframe(stream) -> bytes | None:
    """The next record's payload; None at the end of the file."""
    head = stream.read(struct.calcsize(HEAD))
    if not head:
        return None
    if len(head) != struct.calcsize(HEAD):
        raise DamagedRecord("the file ends within a record")
    length, check = struct.unpack(HEAD, head)
    if masked_checksum(head[:8]) != check:
        raise DamagedRecord("the length of a record is damaged")
    payload = _exact(stream, length)
    if masked_checksum(payload) != struct.unpack(TAIL, _exact(stream, struct.calcsize(TAIL)))[0]:
        raise DamagedRecord("the content of a record is damaged")
    return payload


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _header(width: int) -> bytes:
    return json.dumps({"format": "token-records", "version": 1, "id_bytes": width}).encode()


def _width(payload: bytes) -> int:
    head = json.loads(payload)
    if head.get("format") != "token-records":
        raise DamagedRecord("not a file of token records")
    return head["id_bytes"]


def _writer(root: str, tokenizer: str, end_id: int | None, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _store(root)
        name = f"{folder}/{uuid.uuid4().hex}"
        end = b"" if end_id is None else struct.pack("<I", end_id)
        codec = encoder(tokenizer)
        out = None
        n_records = n_tokens = 0
        first = None
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            if not ids:
                continue
            if out is None:
                store.create_dir(folder, recursive=True)
                out, index = store.open_output_stream(f"{name}.rec"), store.open_output_stream(f"{name}.idx")
                head = frame(_header(width))
                out.write(head)
                offset = len(head)
                first = ids[0]
            for at in range(0, len(ids), 256):
                pieces, entries = [], []
                for doc_id, data in zip(ids[at : at + 256], codec.encode(texts[at : at + 256]), strict=True):
                    data += end
                    count = len(data) // 4
                    if width == 2:
                        data = np.frombuffer(data, dtype="<u4").astype("<u2").tobytes()
                    record = frame(struct.pack(KEY, doc_id is None, doc_id or 0) + data)
                    pieces.append(record)
                    entries.append(struct.pack(ENTRY, doc_id is None, doc_id or 0, offset, len(record), count))
                    offset += len(record)
                    n_records += 1
                    n_tokens += count
                out.write(b"".join(pieces))
                index.write(b"".join(entries))
        if out is not None:
            out.close()
            index.close()
            yield pa.RecordBatch.from_pydict(
                {
                    "file": [f"{root}/{name.rsplit('/', 1)[1]}.rec"],
                    "index": [f"{root}/{name.rsplit('/', 1)[1]}.idx"],
                    "n_records": [n_records],
                    "n_tokens": [n_tokens],
                    "first_null": [first is None],
                    "first_id": pa.array([first], type=pa.int64()),
                }
            )

    return run


def write_records(
    documents: DataFrame, tokenizer: str, end_id: int | None = None, files: int | None = None, wide: bool = False
) -> DataFrame:
    """Write ``doc_id, text`` in ascending order of ids; the manifest, a row for each file.

    ``tokenizer`` is a file of the tokenizers library. Two-byte ids are used if all ids of the
    vocabulary fit, unless ``wide``.
    """
    spark = documents.sparkSession
    largest = max(encoder(tokenizer).tokenizer.get_vocab_size(with_added_tokens=True) - 1, end_id or 0)
    width = 4 if wide or largest > 0xFFFF else 2
    root = fresh_path(spark, "token-records")
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dealt = rows.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id", "text")
    manifest = dealt.mapInArrow(_writer(root, tokenizer, end_id, width), _MANIFEST)
    return written(spark, manifest, "token-manifest")


def _payload(payload: bytes, width: int) -> tuple[int | None, np.ndarray]:
    null, doc_id = struct.unpack_from(KEY, payload)
    ids = np.frombuffer(payload, dtype="<u2" if width == 2 else "<u4", offset=struct.calcsize(KEY))
    return (None if null else doc_id), ids.astype("<u4", copy=False)


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            store, name = _store(path)
            with store.open_input_stream(name, buffer_size=CHUNK_BYTES) as stream:
                width = _width(unframe(stream))
                rows, place = [], 0
                while (payload := unframe(stream)) is not None:
                    doc_id, ids = _payload(payload, width)
                    rows.append((path, doc_id, place, len(ids), zlib.crc32(ids.tobytes())))
                    place += len(ids)
                    if len(rows) == 4096:
                        yield _batch(rows)
                        rows = []
                yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ("file", "doc_id", "place", "n_tokens", "ids_crc32")
    kinds = (pa.string(), *[pa.int64()] * 4)
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)], list(names))


def _spread(frame_: DataFrame) -> DataFrame:
    """Files dealt over tasks, one by one."""
    return frame_.repartition(int(frame_.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def read_records(manifest: DataFrame) -> DataFrame:
    """Every record of the listed files, read in sequence and checked: where its ids start among all
    ids, how many there are and their checksum. The running sum is over files, not over records."""
    ordered = Window.orderBy(F.desc("first_null"), "first_id").rowsBetween(Window.unboundedPreceding, -1)
    bases = manifest.select("file", F.coalesce(F.sum("n_tokens").over(ordered), F.lit(0)).alias("base"))
    records = _spread(manifest.select("file")).mapInArrow(_reader, _RECORD)
    # One row a file: without the hint the side whose stage ends first may be sent out, which can be the records.
    return records.join(F.broadcast(bases), "file").select(
        "doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", "file"
    )


def _index_reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, index in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            store, name = _store(index)
            with store.open_input_stream(name) as stream:
                while data := stream.read(struct.calcsize(ENTRY) * 65536):
                    rows = [(path, None if n else d, o, size, c) for n, d, o, size, c in struct.iter_unpack(ENTRY, data)]
                    columns = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(columns[0], type=pa.string()), *(pa.array(c, type=pa.int64()) for c in columns[1:])],
                        ["file", "doc_id", "offset", "length", "n_tokens"],
                    )


def read_index(manifest: DataFrame) -> DataFrame:
    """The offset index: where each record lies."""
    return _spread(manifest.select("file", "index")).mapInArrow(_index_reader, _INDEX)


def _fetcher(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    open_path, stream, width = None, None, 0
    for batch in batches:
        rows = []
        for path, offset in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if path != open_path:
                store, name = _store(path)
                open_path, stream = path, store.open_input_file(name)
                width = _width(unframe(stream))
            stream.seek(offset)
            doc_id, ids = _payload(unframe(stream), width)
            rows.append((path, offset, doc_id, ids.tolist()))
        if rows:
            files, offsets, ids_, lists = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(files, type=pa.string()),
                    pa.array(offsets, type=pa.int64()),
                    pa.array(ids_, type=pa.int64()),
                    pa.array(lists, type=pa.list_(pa.int64())),
                ],
                ["file", "offset", "doc_id", "ids"],
            )


def fetch_records(entries: DataFrame) -> DataFrame:
    """The records at ``file, offset``, in the order of the rows: shuffled reads by seeking."""
    return entries.select("file", "offset").mapInArrow(_fetcher, _FETCHED)


def op4_binary_records(documents: DataFrame, tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    """Write all documents, read the files back and report each document's ids."""
    manifest = write_records(documents, tokenizer or file_of("byte_bpe_50k.json"), end_id)
    return read_records(manifest).select("doc_id", "start", "n_tokens", "ids_crc32")
