"""What happens when writes break off, meet, or follow each other."""

from __future__ import annotations

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tests.builders import fhv, raw_zones, yellow
from tests.conftest import rows
from tripmart import storage, workspace
from tripmart.operators import lock, upsert
from tripmart.operators import quality as q
from tripmart.operators.proofs import Proofs
from tripmart.operators.refresh import current_path, read_current, refresh
from tripmart.plans import gold, jobs, silver
from tripmart.schemas import CONTRACTS


# Full refresh ------------------------------------------------------------------------------


def test_a_refresh_that_breaks_off_leaves_the_old_table(spark, tmp_path):
    path = f"{tmp_path}/dim"
    assert read_current(spark, path) is None
    old = spark.range(40).repartition(4)
    refresh(spark, old, path)
    half = old.where("id < 20").select(F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        refresh(spark, half, path)
    assert rows(read_current(spark, path)) == rows(old)
    # What the broken build wrote is never read, and goes with the next one.
    refresh(spark, old.where("id < 5"), path)
    assert read_current(spark, path).count() == 5
    assert len([n for n in os.listdir(path) if n.startswith("_v-")]) == 2


def test_readers_of_the_old_version_finish(spark, tmp_path):
    path = f"{tmp_path}/dim"
    before = refresh(spark, spark.range(7), path)
    refresh(spark, before.where("id > 2"), path)
    assert before.count() == 7 and read_current(spark, path).count() == 4
    # The folder as it is holds no table, so that versions aren't read together.
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA"):
        spark.read.parquet(path)


def test_tables_without_versions_are_read_and_become_such(spark, tmp_path):
    path = f"{tmp_path}/plain"
    spark.range(3).write.parquet(path)
    assert current_path(spark, path) == path and read_current(spark, path).count() == 3
    refresh(spark, spark.range(9), path)
    assert read_current(spark, path).count() == 9


# One writer at a time -----------------------------------------------------------------------


def test_the_second_of_two_loads_is_refused(spark, tmp_path):
    table = upsert.daily_table(f"{tmp_path}/daily")
    trips = spark.createDataFrame([], CONTRACTS["int_trips_validated"])
    with lock.writing(spark, table.path):
        with pytest.raises(lock.Locked, match="tests local-"):
            upsert.load_increment(spark, table, trips, gold.daily_trips)
    upsert.load_increment(spark, table, trips, gold.daily_trips)
    assert not storage.exists(spark, lock.lock_path(table.path))


def test_a_stale_lock_is_taken_over(spark, tmp_path):
    path = f"{tmp_path}/table"
    assert storage.create_text(spark, lock.lock_path(path), json.dumps({"owner": "gone", "since": "then"}))
    with pytest.raises(lock.Locked, match="gone since then"):
        with lock.writing(spark, path):
            pass
    with lock.writing(spark, path, stale_after=dt.timedelta(0)) as claim:
        assert storage.read_text(spark, lock.lock_path(path)) == claim
    assert not storage.exists(spark, lock.lock_path(path))


def test_a_lock_that_was_taken_over_is_left_to_its_owner(spark, tmp_path):
    path = f"{tmp_path}/table"
    with lock.writing(spark, path) as first:
        old = time.time() - 86400
        os.utime(lock.lock_path(path), (old, old))
        with lock.writing(spark, path) as second:
            assert first != second
            with pytest.raises(lock.Locked):
                lock.renew(spark, path, first)
            lock.renew(spark, path, second)
        storage.create_text(spark, lock.lock_path(path), "another one's")
    assert storage.read_text(spark, lock.lock_path(path)) == "another one's"


def test_a_lock_renewed_meanwhile_is_put_back(spark, tmp_path):
    path = lock.lock_path(f"{tmp_path}/table")
    storage.create_text(spark, path, "fresh")
    assert not lock._take_over(spark, path, "stale")
    assert storage.read_text(spark, path) == "fresh"


def test_a_failed_load_gives_the_lock_back(spark, tmp_path):
    with pytest.raises(OSError):
        with lock.writing(spark, f"{tmp_path}/t"):
            raise OSError
    assert not storage.exists(spark, lock.lock_path(f"{tmp_path}/t"))


# Checks while writing -----------------------------------------------------------------------


def _save(path, mode="overwrite"):
    return lambda rows: rows.write.mode(mode).parquet(path)


def test_checks_counted_while_writing(spark, tmp_path):
    proofs, path = Proofs(spark, f"{tmp_path}/_proofs.json"), f"{tmp_path}/t"
    checks = [q.not_null("m", "id"), q.accepted_range("m", "id", 0, 5)]
    proofs.write(path, spark.range(9), checks, _save(path), whole=True)
    assert proofs.held(path) == {("m", "id", "not_null")}
    # Rows that are added keep what held before only if it holds for them too.
    proofs.write(path, spark.range(3), checks, _save(path, "append"), whole=False)
    assert proofs.held(path) == {("m", "id", "not_null")}
    proofs.write(path, spark.sql("select cast(null as bigint) as id"), checks, _save(path, "append"), whole=False)
    assert proofs.held(path) == set()


def test_proofs_end_when_others_write(spark, tmp_path):
    proofs, path = Proofs(spark, f"{tmp_path}/_proofs.json"), f"{tmp_path}/t"
    proofs.write(path, spark.range(9), [q.not_null("m", "id")], _save(path), whole=True)
    assert proofs.held(path)
    spark.range(1).write.mode("append").parquet(path)
    assert not proofs.held(path)
    proofs.write(path, spark.range(1), [q.not_null("m", "id")], _save(path, "append"), whole=False)
    assert not proofs.held(path)


def test_a_write_that_breaks_off_proves_nothing(spark, tmp_path):
    proofs, path = Proofs(spark, f"{tmp_path}/_proofs.json"), f"{tmp_path}/t"
    proofs.write(path, spark.range(9), [q.not_null("m", "id")], _save(path), whole=True)
    with pytest.raises(OSError):
        proofs.write(path, spark.range(9), [q.not_null("m", "id")], lambda rows: (_ for _ in ()).throw(OSError()), whole=True)
    assert not proofs.held(path)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("landing"))
    day = {"pickup": dt.datetime(2024, 1, 9, 8), "dropoff": dt.datetime(2024, 1, 9, 8, 30)}
    yellow(spark, {}, day, {"tip_amount": 2.5}).coalesce(1).write.parquet(f"{root}/yellow_tripdata_2024-01.parquet")
    fhv(spark, {}, day).coalesce(1).write.parquet(f"{root}/fhv_tripdata_2024-01.parquet")
    raw_zones(spark).coalesce(1).write.option("header", "true").csv(f"{root}/zones")
    found = jobs.Lake(str(tmp_path_factory.mktemp("lake")))
    jobs.run_all(spark, root, f"{root}/zones", found.root, prefix="written")
    return root, found


def test_row_checks_of_stored_trips_add_no_scan(spark, lake, monkeypatch):
    """Only ids are left to look at: nothing else of the stored trips is read."""
    services = ["yellow", "fhv"]
    proven = jobs.proven_checks(spark, lake[1], services)
    wanted = {c.name for c in jobs.suite.row_checks("int_trips_unioned", "int_trips_enriched", "int_trips_validated")}
    assert wanted <= proven and ("stg_yellow_trips", "pickup_datetime", "not_null") in proven
    seen = []
    run_checks = jobs.suite.run_checks
    monkeypatch.setattr(jobs.suite, "run_checks", lambda f, checks, w=None: seen.append((f, checks)) or run_checks(f, checks, w))
    report = jobs.check_quality(spark, lake[1], services)
    assert report.count() == 48 and report.where("failures > 0 and check_name != 'relationships'").isEmpty()
    on_trips = [checks for frame, checks in seen if "trip_id" in frame.columns]
    assert on_trips and {c.kind for checks in on_trips for c in checks} == {"unique"}


def test_stored_contracts(spark, lake):
    report = jobs.check_contracts(spark, lake[1], ["yellow", "fhv"])
    assert {r.status for r in report.where("column_name != 'pickup_date'").collect()} == {"ok"}
    path = lake[1].table("staging", "stg_fhv_trips")
    other = workspace.written(spark, spark.read.parquet(path).withColumn("pickup_zone_id", F.col("pickup_zone_id").cast("bigint")), "other")
    other.coalesce(1).write.mode("append").partitionBy("pickup_date").parquet(path)
    found = jobs.check_contracts(spark, lake[1], ["yellow", "fhv"]).where("status = 'type differs'").collect()
    assert [(r.model, r.column_name, r.stored_type) for r in found] == [("stg_fhv_trips", "pickup_zone_id", "bigint")]


# Views that last ----------------------------------------------------------------------------


def test_a_second_session_reads_the_enriched_trips(spark, lake):
    root, found = lake
    jobs.publish(spark, root, found, "written")
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "America/New_York")
    view = other.table("written_intermediate.int_trips_enriched")
    trips = jobs.read_bronze(spark, found, ["yellow", "fhv"]).drop("pickup_date")
    wanted = silver.enrich(trips, read_current(spark, found.table("staging", "stg_taxi_zones")))
    assert view.columns == CONTRACTS["int_trips_enriched"].names and view.dtypes == wanted.dtypes
    columns = [c for c in view.columns if c != "loaded_at"]
    assert rows(view, *columns) == rows(wanted, *columns) and view.count() > 0


def test_views_follow_a_refresh(spark, lake):
    root, found = lake
    jobs.publish(spark, root, found, "written")
    table = found.table("marts", "dim_zones")
    refresh(spark, read_current(spark, table).where("zone_id = 1"), table)
    # The view still shows the version before, in whole, until it is switched.
    assert spark.table("written_marts.dim_zones").count() > 1
    jobs.publish(spark, root, found, "written")
    assert spark.table("written_marts.dim_zones").count() == 1
