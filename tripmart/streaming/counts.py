"""Daily counts over an event stream with a lateness bound."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.config import DEFAULT_RULES, Rules
from tripmart.functions.time import day_of_instant, instant_of


def daily_counts(
    events: DataFrame, moment: str, keys: Sequence[str], rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Counts per day and key; a day closes once the lookback has passed it.

    Event time has to be a zoned timestamp, so the wall clock is read as UTC.
    """
    return (
        events.withColumn("_moment", instant_of(F.col(moment)))
        .withWatermark("_moment", f"{rules.lookback_days} days")
        .groupBy(F.window("_moment", "1 day").alias("day"), *keys)
        .agg(F.count(F.lit(1)).alias("events"))
        .select(
            day_of_instant(F.col("day.start")).alias("event_date"),
            *keys,
            "events",
        )
    )


#: State on the executors' disks, and checkpoints of what changed only.
STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started within keep their state in RocksDB, so that it isn't bounded by the heap.

    A checkpoint remembers the kind of store it was begun with; older ones go on as they are.
    """
    before = {key: spark.conf.get(key, None) for key in STATE_ON_DISK}
    for key, value in STATE_ON_DISK.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def run_daily_counts(counts: DataFrame, table: str, checkpoint: str) -> None:
    """Append the days closed so far to a parquet table and stop; open days wait in the checkpoint."""
    with state_on_disk(counts.sparkSession):
        query = (
            counts.writeStream.format("parquet")
            .option("path", table)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
    query.awaitTermination()
