"""Plans keep the shape that scales: what shuffles, what is pushed, what is pruned."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tripmart import workspace
from tripmart.operators import upsert
from tripmart.plans import bronze, gold, silver
from tripmart.sources import landing
from verification import fixture


def _initial(frame) -> str:
    """Physical plan before execution."""
    return frame._jdf.queryExecution().executedPlan().toString()


def _final(frame) -> str:
    """Physical plan after execution, as AQE left it."""
    frame.collect()
    return _initial(frame).split("== Initial Plan ==")[0]


def _count(plan: str, operator: str) -> int:
    return len(re.findall(rf"[-:] (?:\*\(\d+\) )?{operator}\b", plan))


@pytest.fixture(scope="module")
def landed(spark, sf_dir):
    return landing.available_services(spark, fixture.landed(spark, sf_dir))


def test_daily_fact_scans_once_and_shuffles_once(spark, sf_dir):
    plan = _initial(fixture.daily(spark, sf_dir))
    assert plan.count("lineitem.parquet") == 1
    assert _count(plan, "Exchange") == 1
    assert _count(plan, "BroadcastHashJoin") == 1
    assert "Window" not in plan and "md5" not in plan
    assert "Python" not in plan


def test_zone_fact_scans_once_and_needs_no_lookup(spark, sf_dir):
    plan = _initial(fixture.zone_fact(spark, sf_dir))
    assert plan.count("lineitem.parquet") == 1
    assert _count(plan, "Exchange") == 1
    assert "Join" not in plan
    # The join form reads the trips twice and shuffles both sides.
    joined = _initial(gold.zone_metrics_joined(fixture.validated_without_zones(spark, sf_dir)))
    assert joined.count("lineitem.parquet") == 2


def test_aggregates_are_partial_before_the_shuffle(spark, sf_dir):
    plan = _initial(fixture.zone_fact(spark, sf_dir))
    assert plan.index("partial_count") > plan.index("Exchange")


def test_lookback_reaches_the_file_scan(landed):
    start = dt.date(2024, 3, 28)
    lazily = upsert.lookback_slice(bronze.stage(landed["yellow"], "yellow", ids=False), start)
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in _initial(lazily)
    plan = _initial(bronze.stage(landed["yellow"], "yellow", since=start))
    scans = re.findall(r"PushedFilters: \[([^\]]*)", plan)
    assert scans and all("GreaterThanOrEqual(tpep_pickup_datetime" in s for s in scans)


def test_lookback_prunes_the_partitions_of_silver(spark, sf_dir):
    path = workspace.fresh_path(spark, "silver-by-day")
    trips = fixture.trips(spark, sf_dir).withColumn(
        "pickup_date", F.col("pickup_datetime").cast("date")
    )
    trips.write.partitionBy("pickup_date").parquet(path)
    recent = upsert.lookback_slice(spark.read.parquet(path), dt.date(2024, 3, 28))
    filters = re.search(r"PartitionFilters: \[([^\]]*)", _initial(recent)).group(1)
    assert "pickup_date" in filters and "2024-03-28" in filters


def test_fact_reads_only_its_columns(spark, landed):
    zones = spark.createDataFrame([(1, "b", "z", "s")], "zone_id int, borough string, "
                                  "zone_name string, service_zone string")
    staged = bronze.stage(landed["yellow"], "yellow", ids=False)
    valid = silver.validate(silver.enrich(staged, zones, roles=("pickup",)))
    plan = _initial(gold.daily_trips(valid))
    schema = re.search(r"ReadSchema: (struct<[^>]*tpep_pickup[^>]*>)", plan).group(1)
    assert "fare_amount" in schema
    for column in ("tolls_amount", "VendorID", "store_and_fwd_flag", "DOLocationID"):
        assert column not in schema


def test_ids_take_one_shuffle_of_rows_when_nothing_is_crowded(spark, sf_dir):
    ids = bronze.stage_tagged(fixture.tagged(spark, sf_dir)).select("trip_id")
    # Before it runs: the count per pickup second moves that one column only.
    counted = re.findall(r"Exchange hashpartitioning\((pickup_datetime#\d+), 8\)", _initial(ids))
    assert counted
    plan = _final(ids)
    assert "_slice" not in plan
    assert _count(plan, "Window") == 1
    row_shuffles = [e for e in re.findall(r"Exchange hashpartitioning\(.*", plan) if "hash#" in e]
    assert len(row_shuffles) == 1


def test_validation_drops_other_services_at_the_scan(spark, sf_dir):
    trips = silver.union_trips(
        [bronze.stage(fixture.raw(spark, sf_dir, s), s, ids=False) for s in ("yellow", "fhv")]
    )
    plan = _initial(trips.where(F.col("trip_type") == "fhv"))
    assert plan.count("lineitem.parquet") == 1
    assert "EqualTo(l_returnflag,N)" in plan


def test_top_k_is_not_a_full_sort(spark, sf_dir):
    dimension = gold.dim_zones(fixture.zones(spark, sf_dir))
    plan = _initial(gold.busiest_zones(fixture.zone_fact(spark, sf_dir), dimension))
    assert "TakeOrderedAndProject" in plan


def test_landing_reports_never_open_the_files(spark, sf_dir):
    plan = _initial(landing.landing_gaps(spark, fixture.landed(spark, sf_dir)))
    assert "ReadSchema: struct<path:string>" in plan


def test_hot_paths_fit_the_compiler(spark, sf_dir):
    """Methods above 8000 bytes of bytecode are never compiled by the JVM."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for frame in (fixture.daily(spark, sf_dir), fixture.zone_fact(spark, sf_dir)):
            plan = frame._jdf.queryExecution().executedPlan()
            code = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(plan)
            sizes = [int(s) for s in re.findall(r"maxMethodCodeSize:(\d+)", code)]
            assert sizes and max(sizes) <= 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_landing_shuffles_line_items_not_the_wider_records(spark, sf_dir):
    plan = _initial(fixture.tagged(spark, sf_dir, by_month=True))
    assert _count(plan, "Exchange") == 1 and "hashpartitioning(_dealt" in plan
    assert plan.index("Generate") < plan.index("hashpartitioning(_dealt")
    assert rows(fixture.tagged(spark, sf_dir, by_month=True)) == rows(fixture.tagged(spark, sf_dir))


def test_staged_trips_numbered_by_day_take_no_second_shuffle(spark, sf_dir):
    raw = fixture.raw(spark, sf_dir, "yellow")
    by_day = bronze.stage(raw, "yellow", by_day=True).drop("loaded_at")
    plan = _final(by_day)
    assert "hashpartitioning(_day" in plan and _count(plan, "Window") == 1
    assert "hashpartitioning(pickup_datetime" not in plan.split("Window", 1)[1].split("Exchange", 1)[0]
    assert rows(by_day) == rows(bronze.stage(raw, "yellow").drop("loaded_at"))
