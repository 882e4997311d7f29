"""Incremental loads: first run, lookback, upsert, late rows."""

from __future__ import annotations

import datetime as dt

import pytest

from tests.builders import raw_zones, yellow
from tests.conftest import rows
from tripmart.operators import upsert
from tripmart.plans import bronze, gold, silver

COLUMNS = ("trip_date", "pickup_borough", "trip_type", "total_trips", "total_fare")


def _trip(day, zone=1, fare=10.0):
    start = dt.datetime(2024, 1, day, 8)
    return {
        "pickup": start,
        "dropoff": start + dt.timedelta(minutes=10),
        "PULocationID": zone,
        "fare_amount": fare,
    }


def _valid(spark, *trips):
    staged = bronze.stage(yellow(spark, *trips), "yellow", ids=False)
    return silver.validate(silver.enrich(staged, bronze.stage_zones(raw_zones(spark))))


def _load(spark, table, *trips, **options):
    return upsert.load_increment(spark, table, _valid(spark, *trips), gold.daily_trips, **options)


def _counts(fact):
    return {(r.trip_date.day, r.pickup_borough): r.total_trips for r in fact.collect()}


@pytest.fixture
def table(tmp_path):
    return upsert.daily_table(str(tmp_path / "daily"))


def test_first_run_loads_everything(spark, table):
    assert upsert.read_fact(spark, table) is None
    assert _counts(_load(spark, table, _trip(1), _trip(20))) == {
        (1, "Manhattan"): 1,
        (20, "Manhattan"): 1,
    }


def test_lookback_updates_inserts_and_ignores_older_rows(spark, table):
    base = [_trip(1), _trip(8), _trip(10)]
    _load(spark, table, *base)
    # Mark is the 10th: the 7th and later are recomputed, the 6th is too late.
    fact = _load(spark, table, *base, _trip(6), _trip(7), _trip(8), _trip(8, zone=2), _trip(12))
    assert _counts(fact) == {
        (1, "Manhattan"): 1,
        (7, "Manhattan"): 1,
        (8, "Manhattan"): 2,
        (8, "Queens"): 1,
        (10, "Manhattan"): 1,
        (12, "Manhattan"): 1,
    }


def test_keys_that_vanish_stay(spark, table):
    _load(spark, table, _trip(10), _trip(10, zone=2))
    assert _counts(_load(spark, table, _trip(10), _trip(10))) == {
        (10, "Manhattan"): 2,
        (10, "Queens"): 1,
    }


def test_replacing_days_drops_vanished_keys(spark, table):
    _load(spark, table, _trip(1), _trip(10), _trip(10, zone=2))
    fact = _load(spark, table, _trip(10), _trip(10), replace=True)
    assert _counts(fact) == {(1, "Manhattan"): 1, (10, "Manhattan"): 2}


def test_empty_table_is_loaded_in_full(spark, table):
    nothing = _trip(1, fare=-1.0)
    assert _counts(_load(spark, table, nothing)) == {}
    assert _counts(_load(spark, table, _trip(1), _trip(9))) == {
        (1, "Manhattan"): 1,
        (9, "Manhattan"): 1,
    }


def test_far_future_pickup_freezes_unless_clamped(spark, tmp_path):
    future = {**_trip(1), "pickup": dt.datetime(2098, 1, 1, 8)}
    future["dropoff"] = future["pickup"] + dt.timedelta(minutes=10)
    for clamp, expected in ((None, 1), (dt.date(2024, 1, 31), 2)):
        table = upsert.daily_table(str(tmp_path / f"daily-{clamp}"))
        _load(spark, table, _trip(30), future)
        fact = _load(spark, table, _trip(30), _trip(30), future, max_event_date=clamp)
        assert _counts(fact)[(30, "Manhattan")] == expected


def test_repeating_a_run_changes_nothing(spark, table):
    trips = [_trip(1), _trip(9), _trip(10)]
    _load(spark, table, *trips)
    first = rows(_load(spark, table, *trips, _trip(9)), *COLUMNS)
    assert rows(_load(spark, table, *trips, _trip(9)), *COLUMNS) == first


def test_increments_equal_a_rebuild_within_the_lookback(spark, tmp_path):
    growing = upsert.daily_table(str(tmp_path / "growing"))
    arrived = []
    for day in range(1, 9):
        arrived += [_trip(day), _trip(max(1, day - 2), zone=2, fare=7.5)]
        fact = _load(spark, growing, *arrived)
    rebuilt = gold.daily_trips(_valid(spark, *arrived))
    assert rows(fact, *COLUMNS) == rows(rebuilt, *COLUMNS)


def test_zone_fact_upsert(spark, tmp_path):
    table = upsert.zone_table(str(tmp_path / "zone"))
    for trips in ([_trip(1), _trip(9)], [_trip(1), _trip(1), _trip(9), _trip(9, zone=2)]):
        fact = upsert.load_increment(spark, table, _valid(spark, *trips), gold.zone_metrics)
    day1, day9 = dt.date(2024, 1, 1), dt.date(2024, 1, 9)
    assert rows(fact, "zone_id", "metric_date", "pickups", "dropoffs") == [
        (1, day1, 1, 0),
        (1, day9, 1, 0),
        (2, day1, 0, 1),
        (2, day9, 1, 2),
    ]


@pytest.mark.parametrize("first_load", [True, False])
def test_run_that_dies_while_replacing_days_is_completed(spark, table, monkeypatch, first_load):
    """Only the newest day gets written; the next run must not start its lookback there."""
    base = [_trip(1), _trip(2)]
    everything = [*base, *(_trip(day) for day in (5, 10, 20))]
    if not first_load:
        _load(spark, table, *base)
    write_days = upsert._write_days

    def die_half_way(rows, target):
        write_days(rows.where("trip_date = date'2024-01-20'"), target)
        raise OSError("lost")

    monkeypatch.setattr(upsert, "_write_days", die_half_way)
    with pytest.raises(OSError, match="lost"):
        _load(spark, table, *everything)
    assert (20, "Manhattan") in _counts(upsert.read_fact(spark, table))
    monkeypatch.setattr(upsert, "_write_days", write_days)
    expected = {(day, "Manhattan"): 1 for day in (1, 2, 5, 10, 20)}
    assert _counts(_load(spark, table, *everything)) == expected


def test_missing_staged_days_are_named(spark, tmp_path):
    table = upsert.daily_table(f"{tmp_path}/daily")
    upsert._note_pending(spark, table, f"{tmp_path}/gone")
    with pytest.raises(upsert.StagedDaysMissing, match="gone"):
        upsert.recover(spark, table)
    upsert.recover(spark, table, drop_missing=True)
    upsert.recover(spark, table)
