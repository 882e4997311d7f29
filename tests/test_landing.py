"""Landed files, lookups and namespaces."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.builders import fhv, yellow
from tests.conftest import rows
from tripmart.plans import bronze
from tripmart.sources import catalog, landing, lookup
from tripmart.sources.footers import footers, spark_type, stored_contract
from verification import fixture
from verification.queries import QUERIES


def _land(root, frames):
    for name, frame in frames.items():
        frame.coalesce(1).write.parquet(f"{root}/{name}")


@pytest.fixture
def flat(spark, tmp_path):
    """Files next to each other, named by service and month."""
    _land(
        tmp_path,
        {
            "yellow_tripdata_2024-01.parquet": yellow(spark, {}, {}),
            "yellow_tripdata_2024-02.parquet": yellow(spark, {}),
            "fhv_tripdata_2024-01.parquet": fhv(spark, {}),
        },
    )
    return str(tmp_path)


def test_flat_files_of_a_service_are_one_relation(spark, flat):
    assert landing.scan_service(spark, flat, "yellow").count() == 3
    assert landing.scan_service(spark, flat, "green") is None
    assert sorted(landing.available_services(spark, flat)) == ["fhv", "yellow"]


def test_partitioned_layout_reads_the_same(spark, flat, tmp_path):
    tagged = landing.tag_services(landing.available_services(spark, flat))
    other = str(tmp_path / "partitioned")
    landing.land(tagged, other, F.lit("2024-01"))
    again = landing.available_services(spark, other)
    for service, frame in landing.available_services(spark, flat).items():
        assert rows(again[service]) == rows(frame)


def test_no_files_at_all(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        landing.available_services(spark, str(tmp_path))


def test_counts_gaps_and_summary(spark, flat):
    counts = landing.source_counts(landing.available_services(spark, flat))
    assert rows(counts) == [("fhv", 1), ("yellow", 3)]
    gaps = rows(landing.landing_gaps(spark, flat))
    assert ("green", "2024-01") in gaps and ("yellow", "2024-03") in gaps
    assert len(gaps) == 9 - 3
    summary = landing.landing_summary(spark, flat).first()
    assert summary.files == 3 and summary.bytes > 0


def test_months_come_from_the_folder_not_from_file_ids(spark):
    paths = spark.createDataFrame(
        [
            ("/x/green_tripdata_2024-03.parquet/part-00000-1234-56.parquet",),
            ("/x/service=fhv_tripdata/month=2024-02/part-00000-9999-99.parquet",),
            ("/x/service=fhv_tripdata/part-00000-9999-99.parquet",),
        ],
        "path string",
    )
    path = F.col("path")
    found = rows(paths.select(landing.file_service(path), landing.file_month(path)))
    assert found == [("fhv", "2024-02"), ("fhv", None), ("green", "2024-03")]


def test_text_na_is_kept_and_empty_is_null(spark, tmp_path):
    csv = tmp_path / "zones.csv"
    csv.write_text(
        "LocationID,Borough,Zone,service_zone\n264,Unknown,N/A,N/A\n265,N/A,Outside of NYC,N/A\n"
        '7,,"A, b",\n'
    )
    expected = [
        (264, "Unknown", "N/A", "N/A"),
        (265, "N/A", "Outside of NYC", "N/A"),
        (7, None, "A, b", None),
    ]
    assert rows(lookup.scan_zones(spark, str(csv))) == expected
    assert rows(lookup.seed_zones(spark, str(csv), str(tmp_path / "seed"))) == expected


def test_catalog_lists_a_layer_by_name(spark, flat, tmp_path):
    catalog.create_namespaces(spark, str(tmp_path / "catalog"), prefix="test")
    paths = {
        f"{s}_tripdata": landing.service_glob(flat, s) for s in ("yellow", "fhv")
    }
    catalog.register_files(spark, "test_raw", paths)
    found = [tuple(r) for r in catalog.list_tables(spark, "test_raw").collect()]
    assert found == [("fhv_tripdata", 1), ("yellow_tripdata", 3)]


def test_an_unreadable_source_ends_no_other_count(spark, tmp_path):
    (tmp_path / "broken.parquet").write_bytes(b"no parquet at all")
    good = spark.range(5)
    bad = spark.read.schema("id long").parquet(f"{tmp_path}/broken.parquet")
    found = {r.source_name: r for r in landing.source_report(spark, {"good": good, "bad": bad}).collect()}
    assert (found["good"].row_count, found["good"].error) == (5, None)
    assert found["bad"].row_count is None and found["bad"].error


def test_an_empty_layer_lists_nothing(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS nothing_here LOCATION '{tmp_path}/db'")
    found = catalog.list_tables(spark, "nothing_here")
    assert found.columns == ["table_name", "row_count"] and found.collect() == []


@pytest.mark.parametrize("kind", ["bigint", "smallint", "double"])
def test_widths_of_numbers_decide_neither_rows_nor_ids(spark, tmp_path, kind):
    records = yellow(spark, {}, {"PULocationID": 7, "payment_type": 2})
    wide = records.withColumns({c: F.col(c).cast(kind) for c in ("PULocationID", "payment_type", "VendorID", "RatecodeID")})
    wanted = bronze.stage(records, "yellow")
    for name, frame in (("mixed", records), ("one", None)):
        root = f"{tmp_path}/{name}"
        wide.write.parquet(f"{root}/service=yellow_tripdata/month=2024-01")
        if frame is not None:
            frame.write.parquet(f"{root}/service=yellow_tripdata/month=2024-02")
        found = landing.scan_service(spark, root, "yellow")
        assert found.schema == records.schema
        staged = bronze.stage(found, "yellow", ids=False)
        assert staged.count() == wanted.count() * (1 if frame is None else 2)
        if frame is None:
            assert rows(bronze.stage(found, "yellow"), "trip_id") == rows(wanted, "trip_id")


def test_landing_summary_writes_service_months_in_tasks_of_their_own(spark, sf_dir, monkeypatch):
    plans = []
    kept = fixture.by_month
    monkeypatch.setattr(fixture, "by_month", lambda records: plans.append(kept(records)) or plans[-1])
    found = QUERIES["landing_summary"](spark, sf_dir).collect()
    months = plans[0].select("service", "month").distinct().count()
    assert [tuple(r) for r in found] == [(months, True)]
    plan = plans[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [service" in plan and "Repartition 1" not in plan


@pytest.fixture
def widths(spark, tmp_path):
    """Files of one service that store the same numbers in several types, one per file."""
    records = yellow(spark, {}, {"PULocationID": 7, "payment_type": 2}).coalesce(1)
    kinds = ("bigint", "smallint", "double", "decimal(10,0)", "float")
    for k, kind in enumerate(kinds):
        changed = {c: F.col(c).cast(kind) for c in ("PULocationID", "payment_type", "VendorID")}
        records.withColumns(changed).write.parquet(f"{tmp_path}/yellow_tripdata_2024-0{k + 1}.parquet")
    other = records.withColumnRenamed("PULocationID", "PUlocationID")
    other.write.parquet(f"{tmp_path}/yellow_tripdata_2024-09.parquet")
    return str(tmp_path), 2 * (len(kinds) + 1)


def test_many_widths_in_one_landing(spark, widths):
    root, wanted = widths
    found = landing.scan_service(spark, root, "yellow")
    assert found.schema == yellow(spark, {}).schema and found.count() == wanted
    assert {r.PULocationID for r in found.collect()} == {1, 7}


def test_footers_are_read_by_one_job(spark, widths):
    """Whatever the number of files and types, one stage opens them all."""
    root, wanted = widths
    files = landing.landed_files(spark, root)
    found = footers(files, 6).collect()
    assert sum(r.n_rows for r in found) == wanted and all(r.error is None for r in found)
    sizes = {r.path: r.bytes for r in files.collect()}
    assert {r.path: r.n_bytes for r in found} == sizes
    plan = footers(files, 6)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "ReadSchema: struct<path:string>" in plan


def test_stored_contract_shows_other_types(spark, widths):
    root, wanted = widths
    profile = footers(landing.landed_files(spark, root))
    expected = {"PULocationID": "int", "fare_amount": "double", "tip_amount": "float", "nothing": "int"}
    report = {(r.column_name, r.stored_type): r for r in stored_contract(profile, expected).collect()}
    assert report["fare_amount", "double"].status == "ok" and report["fare_amount", "double"].stored_rows == wanted
    assert report["PULocationID", "bigint"].status == report["tip_amount", "double"].status == "type differs"
    assert report["nothing", None].status == "missing" and report["nothing", None].files == 6
    assert report["extra", "double"].status == "unexpected"


def test_broken_footers_are_named(spark, widths, tmp_path):
    root, _ = widths
    (tmp_path / "yellow_tripdata_2024-12.parquet").write_bytes(b"no parquet at all")
    broken = footers(landing.landed_files(spark, root)).where("error is not null").collect()
    assert [r.path.rsplit("/", 1)[1] for r in broken] == ["yellow_tripdata_2024-12.parquet"]
    relation = landing.scan_service(spark, root, "yellow")
    (line,) = landing.source_report(spark, {"yellow": relation}).collect()
    assert line.row_count is None and line.error


@pytest.mark.parametrize(
    ("kind", "name"),
    [(pa.uint32(), "bigint"), (pa.decimal128(9, 2), "decimal(9,2)"), (pa.timestamp("us"), "timestamp_ntz"),
     (pa.timestamp("us", "UTC"), "timestamp"), (pa.date32(), "date"), (pa.list_(pa.int32()), "list<element: int32>")],
)
def test_names_of_stored_types(kind, name):
    assert spark_type(kind).replace("item", "element") == name


def test_a_service_month_from_one_task_is_dealt_over_several(spark):
    records = yellow(spark, {}).select("VendorID").crossJoin(spark.range(400, numPartitions=1))
    dealt = landing.dealt(records, F.lit("yellow"), F.lit("2024-01"), [F.col("id")])
    held = dealt.select(F.pmod(F.xxhash64("id"), F.lit(landing.PARTS)).alias("part")).distinct().count()
    assert held == landing.PARTS and dealt.count() == 400
    assert dealt.columns == ["VendorID", "id"]
