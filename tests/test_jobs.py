"""The stored pipeline agrees with the lazily composed one."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.builders import yellow
from tests.conftest import rows
from tripmart import workspace
from tripmart.config import shuffle_settings
from tripmart.plans import jobs
from tripmart.sources import footers, landing
from verification import fixture

DAILY = ("trip_date", "pickup_borough", "trip_type", "total_trips", "total_fare", "avg_fare")


def same_facts(found, wanted):
    """Equal but for the last digits, which the order of addition decides."""
    return len(found) == len(wanted) and all(
        a[:4] == b[:4] and all(x == y or x == pytest.approx(y, rel=1e-12) for x, y in zip(a[4:], b[4:], strict=True))
        for a, b in zip(found, wanted, strict=True)
    )


def csv_of(deployment):
    return deployment[1]


@pytest.fixture(scope="module")
def deployment(spark, sf_dir):
    root = workspace.fresh_path(spark, "test-landing")
    fixture.land(fixture.tagged(spark, sf_dir), root)
    csv = workspace.fresh_path(spark, "test-zones")
    fixture.raw_zones(spark, sf_dir).write.option("header", "true").csv(csv)
    lake = jobs.Lake(workspace.fresh_path(spark, "test-lake"))
    report = jobs.run_all(spark, root, csv, lake.root)
    return root, csv, lake, report


def test_quality_report_of_the_stored_tables(deployment):
    failing = {r.check_name for r in deployment[3].collect() if r.failures}
    assert failing == {"relationships"}


def test_facts_match(spark, sf_dir, deployment):
    lake = deployment[2]
    stored = spark.read.parquet(lake.table("marts", "fct_daily_trips"))
    assert same_facts(rows(stored, *DAILY), rows(fixture.daily(spark, sf_dir), *DAILY))
    zone = spark.read.parquet(lake.table("marts", "fct_zone_metrics"))
    columns = ("zone_id", "metric_date", "trip_type", "pickups", "dropoffs")
    assert rows(zone, *columns) == rows(fixture.zone_fact(spark, sf_dir), *columns)


def test_bronze_ids_match(spark, sf_dir, deployment):
    lake = deployment[2]
    stored = jobs.read_bronze(spark, lake, ["yellow", "green", "fhv"])
    lazily = fixture.trips(spark, sf_dir, ids=True)
    columns = ("trip_id", "trip_type", "pickup_datetime", "tip_amount")
    assert rows(stored, *columns) == rows(lazily, *columns)


def test_later_run_from_a_day_on_gives_the_same_tables(spark, deployment):
    root, csv, lake, _ = deployment
    paths = [lake.table("marts", "fct_daily_trips"),
             lake.table("intermediate", "int_trips_validated")]
    columns = [DAILY, ("trip_id", "pickup_datetime", "avg_speed_mph")]
    before = [rows(spark.read.parquet(p), *c) for p, c in zip(paths, columns, strict=True)]
    jobs.run_all(spark, root, csv, lake.root, since=dt.date(2024, 3, 20))
    after = [rows(spark.read.parquet(p), *c) for p, c in zip(paths, columns, strict=True)]
    assert same_facts(before[0], after[0]) and before[1] == after[1]


def test_published_tables_answer_sql(spark, deployment):
    root, _, lake, _ = deployment
    jobs.publish(spark, root, lake)
    busiest = spark.sql(
        """select z.zone_name, z.borough, sum(m.pickups) as total_pickups
           from marts.fct_zone_metrics m join marts.dim_zones z on m.zone_id = z.zone_id
           group by z.zone_name, z.borough order by total_pickups desc limit 10"""
    )
    assert busiest.count() == 10
    staged = jobs.read_bronze(spark, lake, ["yellow", "green", "fhv"]).drop("pickup_date")
    union = spark.table("intermediate.int_trips_unioned")
    assert union.columns == staged.columns and rows(union, "trip_id", "fare_amount") == rows(staged, "trip_id", "fare_amount")
    assert spark.table("raw.taxi_zones").count() == spark.read.option("header", "true").csv(csv_of(deployment)).count()
    raw = spark.table("raw.yellow_tripdata").count()
    assert raw == landing.scan_service(spark, root, "yellow").count()


def test_views_are_recomputed_on_read(spark, sf_dir, deployment):
    root = deployment[0]
    jobs.register_views(spark, root, fixture.zones(spark, sf_dir))
    valid = spark.sql("select count(*) from int_trips_validated").first()[0]
    assert valid == fixture.validated(spark, sf_dir).count()
    assert spark.sql("select * from stg_fhv_trips").columns[0] == "trip_id"


def test_local_fallback_folder_only_for_local_sessions(spark):
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://host:7077"
        applicationId = "app"

    class Cluster:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        workspace.shared_root(Cluster())
    Cluster.sparkContext.master = "local[2]"
    assert workspace.shared_root(Cluster()) == workspace.shared_root(Cluster())


def test_shuffle_settings_grow_with_the_data():
    assert shuffle_settings(1 << 30)["spark.sql.shuffle.partitions"] == "200"
    assert int(shuffle_settings(100 << 40)["spark.sql.shuffle.partitions"]) == 102400


def test_quality_reads_the_stored_silver_and_stops(spark, tmp_path, sf_dir):
    zones = f"{tmp_path}/zones"
    fixture.raw_zones(spark, sf_dir).write.option("header", "true").csv(zones)
    landing_root = fixture.landed(spark, sf_dir)
    lake = f"{tmp_path}/lake"
    report = jobs.run_all(spark, landing_root, zones, lake)
    assert {r.check_name for r in report.where("failures > 0").collect()} <= {"relationships"}
    path = jobs.Lake(lake).table("intermediate", "int_trips_validated")
    damaged = spark.read.parquet(path).limit(20).withColumns(
        {"trip_id": F.lit(None).cast("string"), "trip_duration_minutes": F.lit(-5).cast("bigint"), "fare_amount": F.lit(-1.0)}
    )
    workspace.written(spark, damaged, "damaged").write.mode("append").partitionBy("pickup_date").parquet(path)
    services = ["yellow", "green", "fhv"]
    found = jobs.check_quality(spark, jobs.Lake(lake), services)
    failed = {(r.model, r.column_name) for r in found.where("failures > 0").collect()}
    assert {("int_trips_validated", "trip_id"), ("int_trips_validated", "trip_duration_minutes")} <= failed
    with pytest.raises(jobs.QualityError):
        jobs.require_quality(found)


def test_a_second_run_rebuilds_the_lookback_only(spark, tmp_path, sf_dir):
    zones, lake = f"{tmp_path}/zones", jobs.Lake(f"{tmp_path}/lake")
    fixture.raw_zones(spark, sf_dir).write.option("header", "true").csv(zones)
    root = fixture.landed(spark, sf_dir)
    jobs.run_all(spark, root, zones, lake.root)
    path = lake.table("intermediate", "int_trips_validated")
    trips = spark.read.parquet(path)
    last = trips.agg(F.max("pickup_date")).first()[0]
    early, late = dt.date(2024, 1, 10), last - dt.timedelta(days=1)
    for day in (early, late):
        workspace.remove(spark, f"{path}/pickup_date={day}")

    def days():
        return {r[0] for r in spark.read.parquet(path).select("pickup_date").distinct().collect()}

    jobs.run_all(spark, root, zones, lake.root)
    assert late in days() and early not in days()
    jobs.run_all(spark, root, zones, lake.root, full=True)
    assert early in days()


def test_files_that_land_later_for_older_days_are_staged(spark, tmp_path, sf_dir):
    zones = f"{tmp_path}/zones"
    fixture.raw_zones(spark, sf_dir).write.option("header", "true").csv(zones)
    root, lake = f"{tmp_path}/landing", jobs.Lake(f"{tmp_path}/lake")
    records = fixture.tagged(spark, sf_dir)
    fixture.land(records.where("service = 'yellow'"), root)
    jobs.run_all(spark, root, zones, lake.root)
    silver = lake.table("intermediate", "int_trips_validated")
    alone = spark.read.parquet(silver).count()
    fixture.land(records.where("service != 'yellow'"), root, mode="append")
    jobs.run_all(spark, root, zones, lake.root, since=dt.date(2024, 3, 30))
    jobs.run_all(spark, root, zones, lake.root)
    services = ["yellow", "green", "fhv"]
    columns = ("trip_id", "trip_type", "pickup_datetime")
    staged = jobs.read_bronze(spark, lake, services)
    assert rows(staged, *columns) == rows(fixture.trips(spark, sf_dir, ids=True), *columns)
    wanted = fixture.validated(spark, sf_dir).count()
    assert alone < wanted == spark.read.parquet(silver).count()


def test_a_file_that_goes_leaves_bronze_and_silver(spark, tmp_path, sf_dir):
    zones = f"{tmp_path}/zones"
    fixture.raw_zones(spark, sf_dir).write.option("header", "true").csv(zones)
    root, lake = f"{tmp_path}/landing", jobs.Lake(f"{tmp_path}/lake")
    fixture.land(fixture.tagged(spark, sf_dir), root)
    jobs.run_all(spark, root, zones, lake.root)
    workspace.remove(spark, f"{root}/service=green_tripdata")
    jobs.run_all(spark, root, zones, lake.root)
    silver = spark.read.parquet(lake.table("intermediate", "int_trips_validated"))
    assert {r[0] for r in silver.select("trip_type").distinct().collect()} == {"yellow", "fhv"}


def test_nothing_is_built_while_files_are_missing(spark, tmp_path, sf_dir):
    root = fixture.landed(spark, sf_dir)
    with pytest.raises(jobs.LandingGaps, match="fhv 2024-07, green 2024-07, yellow 2024-07"):
        jobs.run_all(spark, root, f"{tmp_path}/zones", f"{tmp_path}/lake", months=("2024-01", "2024-07"))
    assert not (tmp_path / "lake").exists()
    jobs.require_landed(spark, root, ("2024-01", "2024-02"))


def test_first_pickups_come_from_the_footers(spark, tmp_path):
    day = dt.datetime(2024, 1, 7, 23, 30)
    for k, frame in enumerate((yellow(spark, {}, {"pickup": day}), yellow(spark, {"pickup": None}), yellow(spark, {}).limit(0))):
        frame.coalesce(1).write.parquet(f"{tmp_path}/yellow_tripdata_2024-0{k + 1}.parquet")
    files = landing.landed_files(spark, str(tmp_path))
    found = footers.least_values(files, "tpep_pickup_datetime")
    assert sorted((r.path[-23:-8], r.least, r.known) for r in found.collect()) and all(r.known for r in found.collect())
    assert landing.earliest_pickup(spark, "yellow", files) == day.date()
    assert landing.earliest_pickup(spark, "yellow", files.where("month = '2024-02'")) is None
    assert not footers.least_values(files, "nothing").first().known
