"""File ingest: every landed file is staged exactly once, whenever the job runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import workspace
from tripmart.config import FILES_PER_BATCH, SERVICES
from tripmart.plans import bronze, silver
from tripmart.sources import landing


def landed_trips(
    spark: SparkSession, root: str, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of the conformed trips of all services, without ids, from files of the declared types.

    Ids number the copies of a key over all rows of a service, which a stream of new files
    cannot know; the batch job assigns them.
    """
    return silver.union_trips(
        [
            bronze.stage(
                landing.stream_service(spark, root, service, files_per_batch), service, ids=False
            )
            for service in SERVICES
        ]
    )


def ingest_new_files(stream: DataFrame, table: str, checkpoint: str) -> None:
    """Append what is new since the last run and stop; the checkpoint remembers files."""
    (
        stream.writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def run_batches(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str
) -> None:
    """Hand every new micro-batch to ``handle`` and stop."""
    (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def trips_of_files(spark: SparkSession, files: DataFrame) -> DataFrame | None:
    """Conformed trips, without ids, of listed files of all services, whatever types they store; None without any."""
    place = workspace.fresh_path(spark, "batch-files")
    named = files.select(landing.file_service(F.col("path")).alias("service"), "path")
    named.where(F.col("service").isNotNull()).write.parquet(place)
    listed = spark.read.schema("service string, path string").parquet(place)
    staged = []
    for (service,) in sorted(listed.select("service").distinct().collect()):
        raw = landing.scan_files(spark, service, listed.where(F.col("service") == service))
        staged.append(bronze.stage(raw, service, ids=False))
    workspace.remove(spark, place)
    return silver.union_trips(staged) if staged else None


def run_landed(
    spark: SparkSession,
    root: str,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    files_per_batch: int = FILES_PER_BATCH,
) -> None:
    """Hand the trips of the files landed since the last run to ``handle``, batch by batch, and stop."""

    def on_files(files: DataFrame, batch_id: int) -> None:
        trips = trips_of_files(spark, files)
        if trips is not None:
            handle(trips, batch_id)

    run_batches(landing.stream_files(spark, root, files_per_batch), on_files, checkpoint)


def ingest_landed(
    spark: SparkSession, root: str, table: str, checkpoint: str, files_per_batch: int = FILES_PER_BATCH
) -> None:
    """Append the trips of new files to a table partitioned by ``ingest_batch``, and stop.

    A batch that is repeated after a failure replaces what it had written.
    """

    def append(trips: DataFrame, batch_id: int) -> None:
        (
            trips.withColumn("ingest_batch", F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("ingest_batch")
            .parquet(table)
        )

    run_landed(spark, root, append, checkpoint, files_per_batch)
