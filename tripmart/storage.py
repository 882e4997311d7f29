"""Small text files beside tables, in whatever store Hadoop's file systems reach."""

from __future__ import annotations

import os
import time
import uuid
from urllib.parse import urlsplit

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _local(path: str) -> str | None:
    parts = urlsplit(path)
    return parts.path if parts.scheme in ("", "file") else None


def exists(spark: SparkSession, path: str) -> bool:
    store, place = _place(spark, path)
    return store.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    store, place = _place(spark, path)
    return [s.getPath().getName() for s in store.listStatus(place)] if store.exists(place) else []


def age(spark: SparkSession, path: str) -> float | None:
    """Seconds since a file was written; None without the file."""
    store, place = _place(spark, path)
    if not store.exists(place):
        return None
    return time.time() - store.getFileStatus(place).getModificationTime() / 1000


def read_text(spark: SparkSession, path: str) -> str | None:
    store, place = _place(spark, path)
    if not store.exists(place):
        return None
    stream = store.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write(store, place, text: str, overwrite: bool) -> None:
    stream = store.create(place, overwrite)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file over another one, in one step where the store has such a step."""
    jvm = spark._jvm
    _, origin = _place(spark, source)
    _, place = _place(spark, target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        place.toUri(), spark._jsc.hadoopConfiguration()
    )
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(context.makeQualified(origin), context.makeQualified(place), options)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a file; readers see the old text or the new one, never a part."""
    beside = f"{path}.{uuid.uuid4().hex}"
    store, place = _place(spark, beside)
    _write(store, place, text, False)
    move(spark, beside, path)


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file unless there is one; whether it was written."""
    local = _local(path)
    store, place = _place(spark, path)
    if local is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            handle = os.open(local, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
        except FileExistsError:
            return False
        with os.fdopen(handle, "w") as file:
            file.write(text)
        return True
    try:
        _write(store, place, text, False)
    except Exception:
        if store.exists(place):
            return False
        raise
    return True
