"""What the footers of Parquet files say, read by tasks: rows, bytes and the type of each column.

Only footers are read, whatever the files' size, one file after the other in each task; the files are
dealt over tasks one by one. A file that can't be read has its error instead, and no columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart import workspace

PROFILE = "path string, n_rows long, n_bytes long, types map<string,string>, error string"

#: Files that one task looks at, at most; their footers are read in turn.
FILES_PER_TASK = 64

# Arrow's names of types and those of Spark.
_TYPES = {
    "bool": "boolean",
    "int8": "tinyint",
    "int16": "smallint",
    "int32": "int",
    "int64": "bigint",
    "uint8": "smallint",
    "uint16": "int",
    "uint32": "bigint",
    "uint64": "decimal(20,0)",
    "halffloat": "float",
    "float": "float",
    "double": "double",
    "string": "string",
    "large_string": "string",
    "binary": "binary",
    "large_binary": "binary",
    "date32[day]": "date",
}


def spark_type(kind: pa.DataType) -> str:
    """The type that Spark reads a stored column as; Arrow's own name where there is no simple one."""
    if pa.types.is_decimal(kind):
        return f"decimal({kind.precision},{kind.scale})"
    if pa.types.is_timestamp(kind):
        return "timestamp" if kind.tz else "timestamp_ntz"
    return _TYPES.get(str(kind), str(kind))


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path as Spark writes it, and the path within."""
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), path.removeprefix("file:").replace("//", "/", 1) if parts.scheme else path
    scheme = {"s3a": "s3", "s3n": "s3"}.get(parts.scheme, parts.scheme)
    return fs.FileSystem.from_uri(f"{scheme}://{parts.netloc}{quote(path.split(parts.netloc, 1)[1])}")


def _profile(path: str) -> tuple:
    try:
        store, name = opened(path)
        with store.open_input_file(name) as file:
            size = file.size()
            found = pq.ParquetFile(file)
            # The old form of instants, which Spark still writes, says nothing of a zone.
            instants = {c.path for c in map(found.schema.column, range(len(found.schema))) if c.physical_type == "INT96"}
            types = [(f.name, "timestamp" if f.name in instants else spark_type(f.type)) for f in found.schema_arrow]
            return path, found.metadata.num_rows, size, types, None
    except Exception as error:  # whatever the store or the format raises
        return path, None, None, [], (str(error).splitlines() or [type(error).__name__])[0]


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.map_(pa.string(), pa.string()), pa.string())
    for batch in batches:
        for begin in range(0, batch.num_rows, FILES_PER_TASK):
            rows = [_profile(path) for path in batch.column(0).slice(begin, FILES_PER_TASK).to_pylist()]
            columns = zip(zip(*rows, strict=True), kinds, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=k) for c, k in columns], ["path", "n_rows", "n_bytes", "types", "error"]
            )


def footers(files: DataFrame, n_files: int | None = None) -> DataFrame:
    """A row for each ``path`` of a listing; ``n_files``, if known, sets the number of tasks."""
    workspace.ship_modules(files.sparkSession)
    tasks = -(-n_files // FILES_PER_TASK) if n_files else None
    paths = files.select(F.col("path").cast("string").alias("path"))
    dealt = paths.repartition(max(1, tasks), "path") if tasks else paths
    return dealt.mapInArrow(_profiles, PROFILE)


LEAST = "path string, least date, known boolean"


def _least(path: str, column: str) -> tuple:
    try:
        store, name = opened(path)
        with store.open_input_file(name) as file:
            found = pq.ParquetFile(file).metadata
        names = [found.schema.column(k).path.lower() for k in range(len(found.schema))]
        place = names.index(column.lower())
        days = []
        for k in range(found.num_row_groups):
            part = found.row_group(k).column(place)
            statistics = part.statistics
            if statistics is None or not (statistics.has_min_max or statistics.null_count == part.num_values):
                return path, None, False
            if statistics.has_min_max:
                days.append(statistics.min.date())
        return path, min(days, default=None), True
    except Exception:  # unreadable here: whoever reads the file for its values will say why
        return path, None, False


def least_values(files: DataFrame, column: str) -> DataFrame:
    """The first day of a column of times in each ``path``, from the footers' statistics; not ``known`` without them."""
    workspace.ship_modules(files.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_least(path, column) for path in batch.column(0).to_pylist()]
            if rows:
                columns = zip(zip(*rows, strict=True), (pa.string(), pa.date32(), pa.bool_()), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in columns], ["path", "least", "known"])

    return files.select(F.col("path").cast("string").alias("path")).mapInArrow(run, LEAST)


def stored_type(types: Column, column: str) -> Column:
    """The stored type of a column, whatever the case of its letters; null if the file lacks it."""
    named = F.map_filter(types, lambda name, _: F.lower(name) == column.lower())
    return F.get(F.map_values(named), F.lit(0))


def stored_contract(profile: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Per column: expected type, each stored type with its files, rows and bytes, and whether they agree.

    Unlike a frame's schema this tells what lies in the files, where a column may have several types.
    A column that no contract expects shows as ``unexpected``, one that some file lacks as ``missing``.
    """
    sound = profile.where(F.col("error").isNull())
    wanted = F.map_from_arrays(F.array(*map(F.lit, expected)), F.array(*map(F.lit, expected.values())))
    there = sound.select("n_rows", "n_bytes", F.explode("types").alias("column_name", "stored_type"))
    names = F.array(*map(F.lit, expected))
    lacking = sound.select(
        "n_rows",
        "n_bytes",
        F.explode(F.array_except(names, F.map_keys("types"))).alias("column_name"),
        F.lit(None).cast("string").alias("stored_type"),
    )
    counted = (
        there.unionByName(lacking)
        .groupBy("column_name", "stored_type")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("n_rows").alias("stored_rows"),
            F.sum("n_bytes").alias("file_bytes"),
        )
    )
    of_contract = F.try_element_at(wanted, F.col("column_name"))
    status = (
        F.when(F.col("stored_type").isNull(), "missing")
        .when(of_contract.isNull(), "unexpected")
        .when(of_contract == F.col("stored_type"), "ok")
        .otherwise("type differs")
    )
    return counted.select(
        "column_name", of_contract.alias("expected_type"), "stored_type", "files", "stored_rows", "file_bytes",
        status.alias("status"),
    )
