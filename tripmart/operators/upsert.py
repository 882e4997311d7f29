"""Fact tables kept current by a keyed upsert with a late-data lookback.

A fact is a parquet table partitioned by its day. Whole days are the unit of change: the
lookback cuts at midnight, so a recomputed day is always complete.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmart import storage, workspace
from tripmart.config import DEFAULT_RULES, Rules
from tripmart.functions.time import midnight
from tripmart.operators.lock import writing
from tripmart.schemas import CONTRACTS, DAILY_KEYS, ZONE_KEYS


@dataclass(frozen=True)
class FactTable:
    path: str
    keys: tuple[str, ...]
    day: str
    schema: StructType


def daily_table(path: str) -> FactTable:
    return FactTable(path, tuple(DAILY_KEYS), "trip_date", CONTRACTS["fct_daily_trips"])


def zone_table(path: str) -> FactTable:
    return FactTable(path, tuple(ZONE_KEYS), "metric_date", CONTRACTS["fct_zone_metrics"])


def read_fact(spark: SparkSession, table: FactTable) -> DataFrame | None:
    """The fact, or None before its first load."""
    if not storage.exists(spark, table.path):
        return None
    stored = spark.read.schema(table.schema).parquet(table.path)
    return stored.select(*table.schema.names)


def high_water_mark(fact: DataFrame, day: str) -> DataFrame:
    return fact.agg(F.max(day).alias("high_water_mark"))


def lookback_start(
    fact: DataFrame | None,
    day: str,
    rules: Rules = DEFAULT_RULES,
    max_event_date: dt.date | None = None,
) -> dt.date | None:
    """First day to recompute; None asks for a full load (no table, or an empty one).

    The single date is read eagerly so that it reaches the scan as a literal and prunes
    partitions and row groups. ``max_event_date`` keeps a pickup dated far in the future
    from freezing all later increments.
    """
    if fact is None:
        return None
    mark = high_water_mark(fact, day).first()["high_water_mark"]
    if mark is None:
        return None
    if max_event_date is not None:
        mark = min(mark, max_event_date)
    return mark - dt.timedelta(days=rules.lookback_days)


def lookback_slice(trips: DataFrame, start: dt.date | None) -> DataFrame:
    if start is None:
        return trips
    recent = F.col("pickup_datetime") >= midnight(start)
    if "pickup_date" in trips.columns:
        recent = recent & (F.col("pickup_date") >= F.lit(start))
    return trips.where(recent)


def merge_rows(old: DataFrame, new: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Update or insert by key; keys that are only in ``old`` stay."""
    kept = old.join(new.select(*keys), list(keys), "left_anti")
    return kept.select(*new.columns).unionByName(new)


def _write_days(rows: DataFrame, table: FactTable) -> None:
    """Replace exactly the days present in ``rows``.

    A day of a fact is small (zones x services), so one file per day is enough.
    """
    (
        rows.repartition(table.day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(table.day)
        .parquet(table.path)
    )


def _note_pending(spark: SparkSession, table: FactTable, staged: str | None) -> None:
    """Record beside the table which staged days are about to replace its days, or none."""
    note = spark.range(1).select(F.lit(staged).cast("string").alias("staged"))
    note.write.mode("overwrite").parquet(f"{table.path}_pending")


def _publish(spark: SparkSession, table: FactTable, staged: str) -> None:
    _note_pending(spark, table, staged)
    _write_days(spark.read.schema(table.schema).parquet(staged), table)
    _note_pending(spark, table, None)
    workspace.remove(spark, staged)


class StagedDaysMissing(RuntimeError):
    """A replacement of days was cut short and what it had staged is gone."""


def recover(spark: SparkSession, table: FactTable, drop_missing: bool = False) -> None:
    """Finish the replacement of days that an earlier run started and did not complete.

    Days are replaced one after the other. Had a run died after the newest day, the next one
    would start its lookback there and miss older days; the staged days supply them. If they
    are gone, ``StagedDaysMissing`` names them; with ``drop_missing`` the note of them is
    dropped instead, and a full load should follow.
    """
    if not storage.exists(spark, f"{table.path}_pending"):
        return
    note = spark.read.schema("staged string").parquet(f"{table.path}_pending").first()
    staged = note and note["staged"]
    if not staged:
        return
    if not storage.exists(spark, staged):
        if not drop_missing:
            raise StagedDaysMissing(f"{staged}, noted beside {table.path}")
        _note_pending(spark, table, None)
        return
    _publish(spark, table, staged)


def upsert(spark: SparkSession, table: FactTable, new: DataFrame) -> None:
    """Merge recomputed rows into the fact; whole days are staged, then replaced."""
    old = read_fact(spark, table)
    if old is None:
        replace_days(spark, table, new)
        return
    # The fresh rows are read twice: for their days and for the merge.
    path = workspace.fresh_path(spark, "fresh")
    new.write.parquet(path)
    fresh = spark.read.schema(new.schema).parquet(path)
    touched = old.join(fresh.select(table.day).distinct(), table.day, "left_semi")
    replace_days(spark, table, merge_rows(touched, fresh, table.keys))
    workspace.remove(spark, path)


def replace_days(spark: SparkSession, table: FactTable, rows: DataFrame) -> None:
    """Replace every day that is present in ``rows`` as a whole.

    The rows may come from the table itself, so they are written to the shared folder before
    the table is touched.
    """
    staged = workspace.fresh_path(spark, "days")
    rows.write.parquet(staged)
    _publish(spark, table, staged)


def load_increment(
    spark: SparkSession,
    table: FactTable,
    validated: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    rules: Rules = DEFAULT_RULES,
    replace: bool = False,
    max_event_date: dt.date | None = None,
) -> DataFrame:
    """One run of a fact: first load, or lookback slice plus upsert. Returns the table.

    With ``replace`` recomputed days are replaced as a whole instead of merged by key. One load at a
    time: a second one is refused while the first holds the table's lock.
    """
    with writing(spark, table.path):
        recover(spark, table)
        start = lookback_start(read_fact(spark, table), table.day, rules, max_event_date)
        rows = build(lookback_slice(validated, start)).select(*table.schema.names)
        if replace:
            replace_days(spark, table, rows)
        else:
            upsert(spark, table, rows)
    return read_fact(spark, table)
