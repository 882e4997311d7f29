"""One writer at a time: a lock file beside what is written.

The file is created exclusively, and names its owner and when it was taken. A writer that finds one is
refused. A lock older than ``stale_after`` is taken over: its owner is held to have died; what it left
unfinished is completed by the next load (``upsert.recover``). A load that may take longer has to
``renew`` its lock now and then.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from tripmart import storage, workspace

STALE_AFTER = dt.timedelta(hours=12)


class Locked(RuntimeError):
    """Someone else is writing; the message says who and since when."""


def lock_path(path: str) -> str:
    return f"{path.rstrip('/')}_lock"


def _claim(spark: SparkSession) -> str:
    owner = {
        "owner": f"{spark.sparkContext.appName} {spark.sparkContext.applicationId}",
        "since": dt.datetime.now(dt.UTC).isoformat(timespec="seconds"),
        "token": uuid.uuid4().hex,
    }
    return json.dumps(owner)


def _refusal(path: str, held: str | None) -> Locked:
    try:
        owner = json.loads(held or "")
        return Locked(f"{path} is being written by {owner['owner']} since {owner['since']}")
    except (ValueError, KeyError):
        return Locked(f"{path} is being written")


def _take_over(spark: SparkSession, lock: str, held: str | None) -> bool:
    """Move a stale lock out of the way; false if it isn't the one that was found stale any more."""
    aside = f"{lock}.{uuid.uuid4().hex}"
    try:
        storage.move(spark, lock, aside)
    except Exception:
        if storage.exists(spark, lock):
            raise
        return True  # released or taken over meanwhile: creating the file decides
    found = storage.read_text(spark, aside)
    if found != held:
        storage.create_text(spark, lock, found or "")
    workspace.remove(spark, aside)
    return found == held


def renew(spark: SparkSession, path: str, claim: str) -> None:
    """Count the age of one's own lock from now on."""
    if storage.read_text(spark, lock_path(path)) != claim:
        raise Locked(f"the lock of {path} was taken over")
    storage.put_text(spark, lock_path(path), claim)


@contextmanager
def writing(spark: SparkSession, path: str, stale_after: dt.timedelta = STALE_AFTER) -> Iterator[str]:
    """Hold the lock of a table (or of a whole lake) while writing; ``Locked`` if someone else does."""
    lock, claim = lock_path(path), _claim(spark)
    if not storage.create_text(spark, lock, claim):
        held, age = storage.read_text(spark, lock), storage.age(spark, lock)
        stale = age is None or age > stale_after.total_seconds()
        if not (stale and _take_over(spark, lock, held) and storage.create_text(spark, lock, claim)):
            raise _refusal(path, held)
    try:
        yield claim
    finally:
        if storage.read_text(spark, lock) == claim:
            workspace.remove(spark, lock)
