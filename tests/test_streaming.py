"""Streams end where the batch ends, also after repeats and late files."""

from __future__ import annotations

import datetime as dt
import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from tests.builders import fhv, raw_zones, yellow
from tests.conftest import rows
from tripmart.operators import upsert
from tripmart.plans import bronze, gold, silver
from tripmart.sources import landing
from tripmart.streaming import counts, daily, ingest
from verification import fixture

COLUMNS = ("trip_date", "pickup_borough", "trip_type", "total_trips", "total_fare")


def _at(day, **values):
    start = dt.datetime(2024, 1, day, 8)
    return {"pickup": start, "dropoff": start + dt.timedelta(minutes=10), **values}


def _drop(spark, root, name, frame):
    frame.coalesce(1).write.parquet(f"{root}/{name}")


def test_files_are_ingested_once(spark, tmp_path):
    root, table, progress = (str(tmp_path / n) for n in ("landing", "table", "progress"))

    def run():
        ingest.ingest_new_files(ingest.landed_trips(spark, root), table, progress)
        return spark.read.parquet(table).count()

    _drop(spark, root, "yellow_tripdata_2024-01.parquet", yellow(spark, {}, {}))
    assert run() == 2
    assert run() == 2
    _drop(spark, root, "fhv_tripdata_2024-01.parquet", fhv(spark, {}))
    assert run() == 3


@pytest.fixture
def stream(spark, tmp_path):
    """(landing root, fact table, function that runs the stream)."""
    root, silver_path, progress = (str(tmp_path / n) for n in ("landing", "silver", "progress"))
    table = upsert.daily_table(str(tmp_path / "daily"))
    zones = bronze.stage_zones(raw_zones(spark))

    def run():
        daily.stream_daily(spark, root, zones, silver_path, table, progress)
        return {(r.trip_date.day, r.trip_type): r.total_trips
                for r in upsert.read_fact(spark, table).collect()}

    return root, table, run


def test_daily_fact_follows_the_files(spark, stream):
    root, table, run = stream
    _drop(spark, root, "yellow_tripdata_2024-01.parquet", yellow(spark, _at(8), _at(10)))
    assert run() == {(8, "yellow"): 1, (10, "yellow"): 1}
    # Within three days of the 10th: the 8th grows, the 3rd is too late for the fact.
    late = yellow(spark, _at(8), _at(3))
    _drop(spark, root, "yellow_tripdata_2024-01b.parquet", late)
    _drop(spark, root, "fhv_tripdata_2024-01.parquet", fhv(spark, _at(11)))
    expected = {(8, "yellow"): 2, (10, "yellow"): 1, (11, "fhv"): 1}
    assert run() == expected
    assert run() == expected


def test_batch_without_valid_trips(spark, stream):
    root, table, run = stream
    _drop(spark, root, "yellow_tripdata_2024-01.parquet", yellow(spark, _at(8, fare_amount=-1.0)))
    assert run() == {}


def test_repeated_batch_replaces_itself(spark, tmp_path):
    zones = bronze.stage_zones(raw_zones(spark))
    staged = bronze.stage(yellow(spark, _at(8), _at(9)), "yellow", ids=False)
    trips = silver.validate(silver.enrich(staged, zones))
    path = str(tmp_path / "silver")
    for _ in range(2):
        daily._append_batch(trips, 0, path)
    assert spark.read.parquet(path).count() == 2


def test_stream_equals_batch(spark, stream):
    root, table, run = stream
    for month, days in (("2024-01", (1, 2)), ("2024-02", (3, 4)), ("2024-03", (5,))):
        records = yellow(spark, *(_at(d, fare_amount=float(d)) for d in days for _ in range(3)))
        _drop(spark, root, f"yellow_tripdata_{month}.parquet", records)
        run()
    raw = landing.scan_service(spark, root, "yellow")
    zones = bronze.stage_zones(raw_zones(spark))
    trips = silver.validate(silver.enrich(bronze.stage(raw, "yellow", ids=False), zones))
    stored = upsert.read_fact(spark, table)
    assert rows(stored, *COLUMNS) == rows(gold.daily_trips(trips), *COLUMNS)


def test_days_close_after_the_lateness_bound(spark, tmp_path):
    source, table = str(tmp_path / "events"), str(tmp_path / "closed")
    moments = [dt.datetime(2024, 1, d, 23, 30) for d in (1, 1, 2, 3, 6)]
    events = spark.createDataFrame([(m, "a") for m in moments], "ts timestamp_ntz, kind string")
    events.write.parquet(source)
    stream = spark.readStream.schema(events.schema).parquet(source)
    counted = counts.daily_counts(stream, "ts", ["kind"])
    counts.run_daily_counts(counted, table, str(tmp_path / "progress"))
    # The watermark stands at the 3rd, 23:30, so the 1st and the 2nd are closed.
    assert rows(spark.read.parquet(table).orderBy(F.col("event_date"))) == [
        (dt.date(2024, 1, 1), "a", 2),
        (dt.date(2024, 1, 2), "a", 1),
    ]


def test_old_files_are_ingested(spark, tmp_path, sf_dir):
    """A file that is dated long before the newest one still arrives."""
    root, table, progress = (f"{tmp_path}/{n}" for n in ("landing", "table", "progress"))
    records = fixture.tagged(spark, sf_dir).limit(60)
    seen: set[str] = set()
    counts_after = []
    for age in (0, 30 * 86400):
        fixture.land(records, root, mode="append")
        files = set(glob.glob(f"{root}/**/*.parquet", recursive=True))
        for path in files - seen:
            os.utime(path, (time.time() - age, time.time() - age))
        seen = files
        ingest.ingest_new_files(ingest.landed_trips(spark, root), table, progress)
        counts_after.append(spark.read.parquet(table).count())
    assert counts_after[0] > 0 and counts_after[1] == 2 * counts_after[0]


def test_files_of_any_width_stream(spark, tmp_path):
    root, table, progress = (f"{tmp_path}/{n}" for n in ("landing", "table", "progress"))
    kinds = ("int", "bigint", "double", "float")
    for k, kind in enumerate(kinds):
        wide = {c: F.col(c).cast(kind) for c in ("PULocationID", "passenger_count", "VendorID")}
        _drop(spark, root, f"yellow_tripdata_2024-0{k + 1}.parquet", yellow(spark, {}, _at(k + 1)).withColumns(wide))
    _drop(spark, root, "fhv_tripdata_2024-01.parquet", fhv(spark, {}))
    _drop(spark, root, "unknown_2024-01.parquet", fhv(spark, {}))
    for _ in range(2):
        ingest.ingest_landed(spark, root, table, progress, files_per_batch=2)
        stored = spark.read.parquet(table)
        assert stored.count() == 2 * len(kinds) + 1
    assert stored.select("ingest_batch").distinct().count() > 1
    wanted = bronze.stage(yellow(spark, {}), "yellow", ids=False)
    assert silver.conform(stored).dtypes == silver.union_trips([wanted]).dtypes
    assert {r.passenger_count for r in stored.where("trip_type = 'yellow'").collect()} == {1}


def test_repeated_batch_of_files_replaces_itself(spark, tmp_path, monkeypatch):
    root, table, progress = (f"{tmp_path}/{n}" for n in ("landing", "table", "progress"))
    _drop(spark, root, "yellow_tripdata_2024-01.parquet", yellow(spark, {}, {}))
    run_batches = ingest.run_batches

    def die_before_commit(stream, handle, checkpoint):
        def once(batch, batch_id):
            handle(batch, batch_id)
            raise OSError("lost")

        run_batches(stream, once, checkpoint)

    monkeypatch.setattr(ingest, "run_batches", die_before_commit)
    with pytest.raises(Exception, match="lost"):
        ingest.ingest_landed(spark, root, table, progress)
    assert spark.read.parquet(table).count() == 2
    monkeypatch.setattr(ingest, "run_batches", run_batches)
    ingest.ingest_landed(spark, root, table, progress)
    assert spark.read.parquet(table).count() == 2


def test_order_of_batches_decides_nothing_within_a_run(spark, tmp_path):
    """The newest days come first; older ones of the same run aren't late."""
    root, silver_path, progress = (f"{tmp_path}/{n}" for n in ("landing", "silver", "progress"))
    table = upsert.daily_table(f"{tmp_path}/daily")
    zones = bronze.stage_zones(raw_zones(spark))

    def land(name, day, age):
        _drop(spark, root, name, yellow(spark, _at(day)))
        for path in glob.glob(f"{root}/{name}/*.parquet"):
            os.utime(path, (time.time() - age, time.time() - age))

    def run():
        daily.stream_daily(spark, root, zones, silver_path, table, progress, files_per_batch=1)
        return sorted(r.trip_date.day for r in upsert.read_fact(spark, table).collect())

    land("yellow_tripdata_2024-01a.parquet", 25, 9000)
    land("yellow_tripdata_2024-01b.parquet", 3, 5000)
    land("yellow_tripdata_2024-01c.parquet", 12, 1000)
    assert run() == [3, 12, 25]
    # Of a later run they are.
    land("yellow_tripdata_2024-01d.parquet", 30, 900)
    land("yellow_tripdata_2024-01e.parquet", 23, 500)
    land("yellow_tripdata_2024-01f.parquet", 20, 300)
    assert run() == [3, 12, 23, 25, 30]


def test_a_run_that_goes_on_keeps_its_lookback(spark, tmp_path):
    table, progress = upsert.daily_table(f"{tmp_path}/daily"), f"{tmp_path}/progress"
    assert daily._run_start(spark, table, progress, daily.DEFAULT_RULES) is None
    zones = bronze.stage_zones(raw_zones(spark))
    trips = silver.validate(silver.enrich(bronze.stage(yellow(spark, _at(20)), "yellow", ids=False), zones))
    upsert.load_increment(spark, table, trips, gold.daily_trips)
    assert daily._run_start(spark, table, progress, daily.DEFAULT_RULES) is None
    daily._note_run(spark, progress, False, None)
    assert daily._run_start(spark, table, progress, daily.DEFAULT_RULES) == dt.date(2024, 1, 17)


def test_open_days_wait_on_disk_between_runs(spark, tmp_path):
    """A run that goes on finds the counts of the days still open, in files of changes."""
    source, table, progress = (f"{tmp_path}/{n}" for n in ("events", "closed", "progress"))
    waves = [[(1, 5), (2, 7)], [(2, 3), (9, 1)], [(9, 4), (20, 1)]]
    found = []
    for k, wave in enumerate(waves):
        moments = [(dt.datetime(2024, 1, day, 10, n), "a") for day, count in wave for n in range(count)]
        events = spark.createDataFrame(moments, "ts timestamp_ntz, kind string")
        events.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        counts.run_daily_counts(counts.daily_counts(stream, "ts", ["kind"]), table, progress)
        found.append({r.event_date.day: r.events for r in spark.read.parquet(table).collect()})
    assert found[-1] == {1: 5, 2: 10, 9: 5}
    state = glob.glob(f"{progress}/state/**/*.changelog", recursive=True)
    assert state and not glob.glob(f"{progress}/state/**/*.delta", recursive=True)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")
