"""Silver and gold semantics on hand-made rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tests.builders import NOON, fhv, raw_zones, yellow
from tests.conftest import rows
from tripmart.plans import bronze, gold, silver

MIN = dt.timedelta(minutes=1)


def _zones(spark, *extra):
    return bronze.stage_zones(raw_zones(spark, *extra))


def _valid(spark, *frames):
    staged = [bronze.stage(f, s, ids=False) for s, f in frames]
    return silver.validate(silver.enrich(silver.union_trips(staged), _zones(spark)))


def test_bounds_are_exclusive(spark):
    records = yellow(
        spark,
        {"dropoff": NOON},
        {"dropoff": NOON + MIN},
        {"dropoff": NOON + 179 * MIN},
        {"dropoff": NOON + 180 * MIN},
        {"fare_amount": 0.0},
        {"fare_amount": 1000.0},
        {"trip_distance": 200.0, "dropoff": NOON + 170 * MIN},
        {"trip_distance": 50.0, "dropoff": NOON + 30 * MIN},
        {"trip_distance": 0.0},
    )
    kept = rows(_valid(spark, ("yellow", records)), "trip_duration_minutes", "trip_distance")
    assert kept == sorted([(10, 0.0), (179, 2.0)], key=repr)


def test_null_duration_is_dropped_and_null_speed_passes(spark):
    no_end = fhv(spark, {"dropoff": None}, {})
    assert _valid(spark, ("fhv", no_end)).count() == 1
    no_speed = yellow(spark, {"trip_distance": 0.0})
    assert rows(_valid(spark, ("yellow", no_speed)), "avg_speed_mph") == [(None,)]


def test_only_the_pickup_zone_is_checked(spark):
    records = fhv(
        spark,
        {"DOLocationID": 264},
        {"PULocationID": 264},
        {"PULocationID": 265},
        {"PULocationID": None},
        {"PULocationID": 999},
    )
    kept = rows(_valid(spark, ("fhv", records)), "pickup_zone_id", "dropoff_zone_id")
    assert kept == [(1, 264), (999, 2)]


def test_daily_fact_of_unmetered_trips(spark):
    fact = gold.daily_trips(_valid(spark, ("fhv", fhv(spark, {}, {"DOLocationID": 3}))))
    row = fact.first()
    assert (row.total_trips, row.total_passengers) == (2, 0)
    assert (row.total_fare, row.total_distance_miles, row.total_tips) == (0.0, 0.0, 0.0)
    assert row.avg_fare is row.avg_distance_miles is row.avg_tip_percentage is None
    assert row.avg_duration_minutes == 10.0


def test_zone_fact_sides(spark):
    """A trip over midnight counts on the pickup day; receiving zones have null measures."""
    late = dt.datetime(2024, 1, 10, 23, 55)
    trips = _valid(
        spark,
        ("yellow", yellow(spark, {"pickup": late, "dropoff": late + 20 * MIN})),
        ("fhv", fhv(spark, {"DOLocationID": None})),
    )
    day = dt.date(2024, 1, 10)
    expected = [
        (1, day, "fhv", 1, 0, 0.0, None),
        (1, day, "yellow", 1, 0, 10.0, 10.0),
        (2, day, "yellow", 0, 1, None, None),
    ]
    columns = (
        "zone_id", "metric_date", "trip_type", "pickups", "dropoffs", "total_fare_from_zone",
        "avg_fare_from_zone",
    )
    assert rows(gold.zone_metrics(trips), *columns) == expected
    assert rows(gold.zone_metrics_joined(trips), *columns) == expected


def test_dimension_flags(spark):
    found = rows(
        gold.dim_zones(_zones(spark)), "zone_id", "is_airport", "is_yellow_zone", "is_nyc_borough"
    )
    assert found == [
        (1, False, True, True),
        (2, True, False, True),
        (3, False, False, False),
        (4, True, False, True),
    ]


def test_report_merges_zones_that_share_a_name(spark):
    dimension = gold.dim_zones(_zones(spark, (5, "Manhattan", "Alpha", "Yellow Zone")))
    fact = spark.createDataFrame(
        [(1, 3, 1), (5, 4, 0), (2, 9, 2), (264, 100, 100)],
        "zone_id int, pickups bigint, dropoffs bigint",
    )
    found = [tuple(r) for r in gold.busiest_zones(fact, dimension).collect()]
    assert found == [("Beta Airport", "Queens", 9, 2), ("Alpha", "Manhattan", 7, 1)]


def test_union_of_what_has_landed(spark):
    only_fhv = silver.union_trips([bronze.stage(fhv(spark, {}), "fhv")])
    both = silver.union_trips(
        [bronze.stage(fhv(spark, {}), "fhv"), bronze.stage(yellow(spark, {}), "yellow")]
    )
    assert only_fhv.dtypes == both.dtypes
    assert both.count() == 2


def test_labels_of_unknown_codes_are_null(spark):
    trips = bronze.stage(
        yellow(spark, {"payment_type": 2}, {"payment_type": 77, "RatecodeID": None}), "yellow"
    )
    found = rows(gold.decode_codes(trips), "payment_label", "rate_label", "vendor_label")
    assert found == [
        ("Cash", "Standard rate", "Creative Mobile"),
        (None, None, "Creative Mobile"),
    ]


def test_rejects_count_every_failed_rule(spark):
    records = yellow(spark, {}, {"fare_amount": -1.0, "PULocationID": 264}, {"PULocationID": None})
    trips = silver.with_measures(bronze.stage(records, "yellow"))
    found = silver.rejects_by_rule(trips).first().asDict()
    assert found["trips"] == 3 and found["rejected"] == 2
    assert (found["failed_fare"], found["failed_zone"], found["failed_speed"]) == (1, 2, 0)


def test_simple_variant_has_speed_zero_without_distance(spark):
    staged = bronze.stage(yellow(spark, {"trip_distance": 0.0}, {}), "yellow", ids=False)
    simple = silver.enrich_yellow_simple(staged, _zones(spark))
    assert rows(simple, "avg_speed_mph") == [(0.0,), (12.0,)]
    assert simple.where(F.col("pickup_zone_name") == "Alpha").count() == 2
