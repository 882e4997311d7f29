"""Scalar expressions: minutes, text of doubles, rounding, measures."""

from __future__ import annotations

import datetime as dt
import random
from fractions import Fraction

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.builders import NOON, green, yellow
from tests.conftest import rows
from tripmart.functions.numeric import rounded_int, speed_mph
from tripmart.functions.sums import exact_totals, mean_of, sum_of
from tripmart.functions.text import double_text
from tripmart.functions.time import day_of, day_of_instant, instant_of, minutes_between
from tripmart.plans import bronze, gold, silver

_T = dt.datetime


def _minutes(spark, pairs):
    frame = spark.createDataFrame(
        [(i, *p) for i, p in enumerate(pairs)], "i int, a timestamp_ntz, b timestamp_ntz"
    )
    found = frame.select("i", minutes_between(F.col("a"), F.col("b")).alias("m")).collect()
    return [r.m for r in sorted(found, key=lambda r: r.i)]


def test_minutes_count_boundaries(spark):
    pairs = [
        (_T(2024, 1, 1, 10, 0, 59), _T(2024, 1, 1, 10, 1, 0)),
        (_T(2024, 1, 1, 10, 1, 0), _T(2024, 1, 1, 10, 0, 59)),
        (_T(2024, 1, 1, 10, 1, 0), _T(2024, 1, 1, 10, 1, 59, 999999)),
        (_T(2024, 1, 1, 23, 59, 30), _T(2024, 1, 2, 0, 0, 10)),
        (_T(1969, 12, 31, 23, 59, 30), _T(1970, 1, 1, 0, 0, 10)),
        (_T(2024, 1, 1), None),
    ]
    assert _minutes(spark, pairs) == [1, -1, 0, 1, 1, None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_daylight_saving_gap_does_not_matter(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        gap = spark.sql(
            "select timestamp_ntz'2024-03-10 02:30:00' a, timestamp_ntz'2024-03-10 03:10:00' b"
        )
        a = F.col("a")
        found = gap.select(
            minutes_between(a, F.col("b")),
            day_of(a).cast("string"),
            day_of_instant(instant_of(a)).cast("string"),
        ).first()
        assert tuple(found) == (40, "2024-03-10", "2024-03-10")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.datetimes(_T(1950, 1, 1), _T(2100, 1, 1)),
            st.datetimes(_T(1950, 1, 1), _T(2100, 1, 1)),
        ),
        min_size=50,
        max_size=50,
    )
)
def test_minutes_match_sql(spark, pairs):
    connection = duckdb.connect()
    expected = [
        connection.execute("select datediff('minute', ?::timestamp, ?::timestamp)", p).fetchone()[0]
        for p in pairs
    ]
    assert _minutes(spark, pairs) == expected


def test_double_text_matches_sql(spark):
    rng = random.Random(7)
    values = [0.0, -0.0, 1e7, 1e-4, 1e-5, 1.25e-5, 1e15, 1e16, 1.5e16, 1e100, 1e-10, 17.7, 0.001]
    values += [float("nan"), float("inf"), float("-inf"), 9999999.5, -2.5e-7, 123456789012345.67]
    values += [round(rng.uniform(-1e9, 1e9), 2) for _ in range(500)]
    values += [round(rng.random(), rng.randint(1, 8)) for _ in range(500)]
    connection = duckdb.connect()
    connection.execute("create table t (i int, x double)")
    connection.executemany("insert into t values (?, ?)", list(enumerate(values)))
    expected = dict(connection.execute("select i, x::varchar from t").fetchall())
    frame = spark.createDataFrame(list(enumerate(values)), "i int, x double")
    found = dict(tuple(r) for r in frame.select("i", double_text(F.col("x"))).collect())
    assert found == expected


def test_rounding_to_even(spark):
    frame = spark.createDataFrame([(1.5,), (2.5,), (3.5,), (-1.5,), (None,)], "x double")
    assert [r[0] for r in frame.select(rounded_int(F.col("x"))).collect()] == [2, 2, 4, -2, None]


def test_speed_is_a_double(spark):
    frame = spark.createDataFrame(
        [(3.5, 7), (3.5, 0), (0.0, 7), (None, 7)], "miles double, minutes bigint"
    )
    found = [r[0] for r in frame.select(speed_mph(F.col("miles"), F.col("minutes"))).collect()]
    assert found == [30.0, None, None, None]


def test_small_amounts_add_up(spark):
    records = [{"tip_amount": 4e-7, "pickup": NOON + dt.timedelta(seconds=i)} for i in range(1000)]
    trips = bronze.stage(yellow(spark, *records), "yellow").withColumn("pickup_borough", F.lit("Queens"))
    fact = gold.daily_trips(silver.with_measures(trips)).first()
    assert fact["total_tips"] == pytest.approx(4e-4, rel=1e-12)


def test_source_trip_type_is_not_shadowed(spark):
    staged = bronze.stage(green(spark, {"trip_type": 2.0}), "green")
    assert rows(staged, "trip_type", "green_trip_type") == [("green", 2)]


def test_null_gates(spark):
    records = yellow(spark, {}, {"pickup": None}, {"dropoff": None})
    assert bronze.stage(records, "yellow").count() == 1


def test_tip_share_has_no_payment_filter(spark):
    trips = bronze.stage(yellow(spark, {"payment_type": 2, "tip_amount": 2.5}), "yellow")
    assert rows(silver.with_measures(trips), "tip_percentage") == [(25.0,)]


# Sums that repeat ---------------------------------------------------------------------------


def _values():
    rnd = random.Random(1)
    return {
        "cents": [rnd.randint(-(10**6), 10**6) / 100 for _ in range(2000)],
        "small": [4e-7] * 1000,
        "wide": [rnd.uniform(-1, 1) * 10 ** rnd.randint(-9, 12) for _ in range(2000)],
        "below zero": [-1e-10, 3e-11, 0.0, None],
        "cancelling": [1e17, 0.1, -1e17, 0.2],
        "large": [4e18] * 5,
        "none": [None, None],
    }


def test_sums_are_exact_and_repeat(spark):
    values = _values()
    frame = spark.createDataFrame([(k, v) for k, some in values.items() for v in some], "k string, v double")
    found = []
    for parts in (1, 3, 8):
        totals = frame.repartition(parts).groupBy("k").agg(exact_totals("v").alias("t"))
        found.append({r.k: (r.s, r.m) for r in totals.select("k", sum_of("t").alias("s"), mean_of("t").alias("m")).collect()})
    assert found[0] == found[1] == found[2]
    for key, some in values.items():
        there = [v for v in some if v is not None]
        total = float(sum(map(Fraction, there))) if there else None
        assert found[0][key] == (total, total / len(there) if there else None), key
    assert found[0]["small"][0] == pytest.approx(4e-4, rel=1e-15)


def test_values_that_cannot_be_cut_are_added_plainly(spark):
    some = {"huge": [1e300, 2e300], "finest": [5e-324, 5e-324], "nan": [float("nan"), 1.0], "endless": [float("inf"), 1.0]}
    frame = spark.createDataFrame([(k, v) for k, values in some.items() for v in values], "k string, v double")
    totals = frame.groupBy("k").agg(exact_totals("v").alias("t"))
    found = {r.k: r.s for r in totals.select("k", sum_of("t").alias("s")).collect()}
    assert found["huge"] == 3e300 and found["finest"] == 1e-323 and found["nan"] != found["nan"] and found["endless"] == float("inf")


@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32) | st.none(), min_size=1, max_size=12))
@settings(max_examples=15, deadline=None)
def test_any_floats_within_reach_sum_exactly(spark, values):
    values = [v if v is None or 1e-6 < abs(v) < 1e15 or v == 0 else 1.5 for v in values]
    frame = spark.createDataFrame([(v,) for v in values], "v double").repartition(2)
    there = [v for v in values if v is not None]
    total = frame.agg(exact_totals("v").alias("t")).select(sum_of("t")).first()[0]
    # The last step may round twice.
    assert total == (pytest.approx(float(sum(map(Fraction, there))), rel=2.3e-16) if there else None)
