"""Trip ids: content, copies, crowded groups."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.builders import NOON, fhv, yellow
from tests.conftest import rows
from tripmart.operators.trip_key import with_trip_id
from tripmart.plans import bronze
from verification import fixture


def _ids(frame):
    return [r.trip_id for r in frame.select("trip_id").collect()]


def test_key_is_the_hash_of_seven_fields(spark):
    text = "2024-01-10 12:00:00|2024-01-10 12:10:00|1|2|10.0|2.0|1.0"
    key = hashlib.md5(text.encode()).hexdigest()
    assert _ids(bronze.stage(yellow(spark, {}), "yellow")) == [f"{key}_1"]


def test_null_and_empty_fields_share_a_key(spark):
    records = fhv(spark, {"Affiliated_base_number": None}, {"Affiliated_base_number": ""})
    text = "2024-01-10 12:00:00|2024-01-10 12:10:00|1|2|B1||"
    key = hashlib.md5(text.encode()).hexdigest()
    assert sorted(_ids(bronze.stage(records, "fhv"))) == [f"{key}_1", f"{key}_2"]


def test_copies_are_numbered_by_their_other_fields(spark):
    records = yellow(spark, {"tip_amount": 3.0}, {"tip_amount": 1.0}, {"tip_amount": None})
    staged = bronze.stage(records, "yellow")
    numbered = [(r.trip_id.split("_")[1], r.tip_amount) for r in staged.collect()]
    assert sorted(numbered) == [("1", None), ("2", 1.0), ("3", 3.0)]


def test_ids_do_not_depend_on_partitioning(spark, sf_dir):
    columns = ("trip_id", "pickup_datetime", "tip_amount", "total_amount")
    raw = fixture.raw(spark, sf_dir, "yellow")
    first = rows(bronze.stage(raw, "yellow"), *columns)
    second = rows(bronze.stage(raw.repartition(13, "PULocationID"), "yellow"), *columns)
    assert first == second


def _keyed(spark):
    """300 exact copies, 120 rows that share a key but differ, and quiet rows."""
    noon, later = NOON, NOON + dt.timedelta(hours=1)
    data = [("yellow", noon, "same", 1.0)] * 300
    data += [("yellow", noon, "mixed", float(i % 60)) for i in range(120)]
    data += [("yellow", later + dt.timedelta(seconds=i), f"k{i}", 0.0) for i in range(50)]
    return spark.createDataFrame(
        data, "trip_type string, pickup_datetime timestamp_ntz, base_hash string, tip_amount double"
    ).repartition(5)


@pytest.mark.parametrize("crowded", [1, 7, 100, 1_000_000])
def test_crowded_groups_are_numbered_without_gaps(spark, crowded):
    keyed = _keyed(spark)
    found = with_trip_id(keyed, crowded=crowded).collect()
    expected = Counter((r.base_hash, r.tip_amount) for r in keyed.collect())
    assert Counter((r.trip_id.split("_")[0], r.tip_amount) for r in found) == expected
    for key, size in (("same", 300), ("mixed", 120)):
        numbers = sorted(
            int(r.trip_id.split("_")[1]) for r in found if r.trip_id.startswith(f"{key}_")
        )
        assert numbers == list(range(1, size + 1))


@pytest.mark.parametrize("crowded", [7, 1_000_000])
def test_numbers_of_rows_repeat_from_run_to_run(spark, crowded):
    def numbered(partitions):
        keyed = _keyed(spark).repartition(partitions)
        stamped = keyed.withColumn("loaded_at", F.current_timestamp())
        return rows(with_trip_id(stamped, crowded=crowded), "trip_id", "tip_amount")

    assert numbered(3) == numbered(8)


def test_ids_do_not_depend_on_the_size_of_a_second(spark):
    """Whatever counts as crowded, and whatever else happens in the same second."""
    keyed = _keyed(spark)
    wanted = rows(with_trip_id(keyed), "trip_id", "tip_amount")
    for crowded in (1, 7, 50):
        assert rows(with_trip_id(keyed, crowded=crowded), "trip_id", "tip_amount") == wanted
    more = [("yellow", NOON, f"other{i}", float(i)) for i in range(15)]
    grown = keyed.union(spark.createDataFrame(more, keyed.schema))
    found = with_trip_id(grown, crowded=10).where(~F.col("trip_id").startswith("other"))
    assert rows(found, "trip_id", "tip_amount") == wanted


def test_crowded_path_spreads_a_group(spark):
    """A key that holds most rows reaches the numbering step in several slices."""
    frame = with_trip_id(_keyed(spark), crowded=10)
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in plan and "_slice" in plan
    assert frame.select("trip_id").distinct().count() == 470


def test_tagged_relation_gives_the_same_rows(spark, sf_dir):
    tagged = bronze.stage_tagged(fixture.tagged(spark, sf_dir))
    for service in ("yellow", "green", "fhv"):
        single = bronze.stage(fixture.raw(spark, sf_dir, service), service).drop("loaded_at")
        own = tagged.where(F.col("trip_type") == service).select(*single.columns)
        assert rows(own) == rows(single)
