"""Facts kept current by a stream of landed files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmart import storage
from tripmart.config import DEFAULT_RULES, FILES_PER_BATCH, Rules
from tripmart.functions.time import day_of
from tripmart.operators.lock import writing
from tripmart.operators.upsert import (
    FactTable,
    lookback_start,
    read_fact,
    recover,
    upsert,
)
from tripmart.plans import gold, silver
from tripmart.streaming.ingest import run_landed

_RUN = "running boolean, since date"


def _append_batch(trips: DataFrame, batch_id: int, silver_path: str) -> StructType:
    """Keep the batch under its own partition, so that a repeated batch replaces itself."""
    kept = trips.withColumns(
        {
            "ingest_batch": F.lit(batch_id).cast("bigint"),
            "pickup_date": day_of(F.col("pickup_datetime")),
        }
    )
    (
        kept.hint("rebalance", "pickup_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingest_batch", "pickup_date")
        .parquet(silver_path)
    )
    return kept.schema


def _run_start(
    spark: SparkSession, table: FactTable, checkpoint: str, rules: Rules
) -> dt.date | None:
    """First day that this run recomputes; None asks for all.

    A run's batches come in the order of the files' times, not of their days, so all of them keep to the
    lookback from before the run. A run that goes on after a failure keeps to that of its begin, which is
    noted beside the checkpoint until the run has ended.
    """
    note = None
    if storage.exists(spark, f"{checkpoint}_run"):
        note = spark.read.schema(_RUN).parquet(f"{checkpoint}_run").first()
    if note is not None and note["running"]:
        return note["since"]
    recover(spark, table)
    since = lookback_start(read_fact(spark, table), table.day, rules)
    _note_run(spark, checkpoint, True, since)
    return since


def _note_run(spark: SparkSession, checkpoint: str, running: bool, since: dt.date | None) -> None:
    note = spark.createDataFrame([(running, since)], _RUN)
    note.coalesce(1).write.mode("overwrite").parquet(f"{checkpoint}_run")


def refresh_daily(
    spark: SparkSession, table: FactTable, trips: DataFrame, batch_id: int, since: dt.date | None
) -> None:
    """Recompute, from all silver rows, the days from ``since`` on that the batch touched.

    A batch that is repeated after a failure first completes what it had begun.
    """
    if since is not None:
        trips = trips.where(F.col("pickup_date") >= F.lit(since))
    touched = trips.where(F.col("ingest_batch") == batch_id).select("pickup_date").distinct()
    affected = trips.join(touched, "pickup_date", "left_semi")
    with writing(spark, table.path):
        recover(spark, table)
        upsert(spark, table, gold.daily_trips(affected).select(*table.schema.names))


def stream_daily(
    spark: SparkSession,
    landing_root: str,
    zones: DataFrame,
    silver_path: str,
    table: FactTable,
    checkpoint: str,
    rules: Rules = DEFAULT_RULES,
    files_per_batch: int = FILES_PER_BATCH,
) -> None:
    """Bring silver and the daily fact up to date with the files landed since the last run, whatever types they
    store. A large landing comes in batches of files."""
    since = _run_start(spark, table, checkpoint, rules)

    def handle(batch: DataFrame, batch_id: int) -> None:
        valid = silver.validate(silver.enrich(batch, zones), rules)
        schema = _append_batch(valid, batch_id, silver_path)
        trips = spark.read.schema(schema).parquet(silver_path)
        refresh_daily(spark, table, trips, batch_id, since)

    run_landed(spark, landing_root, handle, checkpoint, files_per_batch)
    _note_run(spark, checkpoint, False, None)
