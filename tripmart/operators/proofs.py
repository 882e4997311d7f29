"""Checks that were counted while a table was written and needn't be run on it again.

A note beside the tables lists, for each one, the checks no row failed, and a fingerprint of its files (names, sizes
and times). The note holds only as long as the files are those; whatever else writes to the table voids it. A
write of some days keeps what held before for the others.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import storage
from tripmart.operators.quality import Check, Watched

Name = tuple[str, str, str]


def fingerprint(spark: SparkSession, path: str) -> str | None:
    """What the files of a table are, from their listing; None without files."""
    if not storage.exists(spark, path):
        return None
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = reader.option("pathGlobFilter", "*.parquet").load(path)
    each = F.xxhash64("path", "length", "modificationTime")
    found = files.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(each).alias("x"), F.sum("length").alias("bytes")).first()
    return f"{found['n']} {found['bytes']} {found['x']}" if found["n"] else None


class Proofs:
    """The note at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _all(self) -> dict:
        return json.loads(storage.read_text(self.spark, self.path) or "{}")

    def _put(self, table: str, entry: dict | None) -> None:
        notes = {k: v for k, v in self._all().items() if k != table}
        if entry is not None:
            notes[table] = entry
        storage.put_text(self.spark, self.path, json.dumps(notes))

    def held(self, table: str) -> set[Name]:
        """Checks that hold for all rows of a table, as it is now."""
        entry = self._all().get(table)
        if entry is None or entry["files"] != fingerprint(self.spark, table):
            return set()
        return {tuple(name) for name in entry["held"]}

    def write(
        self, table: str, frame: DataFrame, checks: Iterable[Check], save: Callable[[DataFrame], None], whole: bool
    ) -> None:
        """Save rows to a table and note which checks hold; ``whole`` if they replace all its rows."""
        before = set() if whole else self.held(table)
        # Until the rows are written and counted, nothing holds.
        self._put(table, None)
        watched = Watched(frame, checks)
        save(watched.frame)
        held = {check.name for check, n in watched.failing().items() if not n}
        held = held if whole else held & before
        files = fingerprint(self.spark, table)
        if files is not None:
            self._put(table, {"files": files, "held": sorted(held)})
