"""Registered queries: name -> callable of (spark, sf_dir)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import workspace
from tripmart.functions.numeric import rounded_int
from tripmart.operators.quality import (
    contract_profile,
    missing_references,
    run_checks,
)
from tripmart.operators.rules import trip_rules
from tripmart.operators.trip_key import with_surrogate_id
from tripmart.operators import upsert
from tripmart.operators.upsert import (
    FactTable,
    daily_table,
    load_increment,
    read_fact,
    zone_table,
)
from tripmart.plans import bronze, gold, jobs, silver, suite
from tripmart.schemas import CONTRACTS, RAW
from tripmart.sources import catalog, landing, lookup
from tripmart.sources.footers import footers
from tripmart.sources.footers import stored_contract as stored_types
from tripmart.streaming import counts, daily, ingest
from verification import fixture

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


# Values that differ from run to run are left out of every comparison.
_VOLATILE = ("loaded_at", "updated_at")

_RULE_COLUMNS = (
    "trip_type",
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_zone_id",
    "fare_amount",
    "trip_distance",
    "trip_duration_minutes",
    "avg_speed_mph",
)


def query(function: Query) -> Query:
    def stable(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(spark, sf_dir).drop(*_VOLATILE)

    QUERIES[function.__name__] = stable
    return function


# Sources ---------------------------------------------------------------------------------


@query
def scan_trips(spark, sf_dir):
    present = landing.available_services(spark, fixture.landed(spark, sf_dir))
    return landing.tag_services(present)


def _landing_of_widths(spark, sf_dir):
    """Files of one service that store numbers as declared, in the widest integers, and as doubles."""
    root = workspace.fresh_path(spark, "landing-widths")
    records = fixture.raw(spark, sf_dir, "yellow")
    part = F.pmod(F.coalesce("VendorID", F.lit(0)), F.lit(3))
    wide = {name: F.col(name).cast("bigint") for name, kind in records.dtypes if kind == "int"}
    doubles = {name: F.col(name).cast("double") for name in wide}
    whole = {"passenger_count": F.col("passenger_count").cast("bigint")}
    for k, columns in enumerate(({}, wide | whole, doubles)):
        stored = records.where(part == k).withColumns(columns) if columns else records.where(part == k)
        stored.write.parquet(f"{root}/service=yellow_tripdata/month=2024-0{k + 1}")
    return root


@query
def scan_widths(spark, sf_dir):
    """Files of several widths as one relation of the declared types."""
    return landing.scan_service(spark, _landing_of_widths(spark, sf_dir), "yellow")


@query
def stream_widths(spark, sf_dir):
    """The same files as a stream, some of them in each batch."""
    table = workspace.fresh_path(spark, "ingested-widths")
    progress = workspace.fresh_path(spark, "ingested-widths-progress")
    ingest.ingest_landed(spark, _landing_of_widths(spark, sf_dir), table, progress, files_per_batch=4)
    return spark.read.parquet(table).drop("ingest_batch")


@query
def stored_contract(spark, sf_dir):
    """What the same files store, column by column, against what is declared."""
    files = landing.landed_files(spark, _landing_of_widths(spark, sf_dir))
    expected = {f.name: f.dataType.simpleString() for f in RAW["yellow"].fields if f.name != "total_amount"}
    report = stored_types(footers(files), expected | {"airport_fee": "double"})
    return report.select("column_name", "expected_type", "stored_type", "stored_rows", "status")


@query
def landing_profile(spark, sf_dir):
    """Rows of each service month by the files' footers, and whether the listed sizes are the files'."""
    files = landing.landed_files(spark, fixture.landed(spark, sf_dir))
    profile = files.join(footers(files), "path").groupBy("service", "month")
    return profile.agg(
        F.sum("n_rows").alias("stored_rows"),
        F.every(F.col("bytes") == F.col("n_bytes")).alias("sizes_agree"),
        F.count("error").alias("unreadable"),
    )


def _zones_csv(spark, sf_dir):
    path = workspace.fresh_path(spark, "zones-csv")
    fixture.raw_zones(spark, sf_dir).write.option("header", "true").csv(path)
    return path


@query
def scan_zones(spark, sf_dir):
    return lookup.scan_zones(spark, _zones_csv(spark, sf_dir))


@query
def seed_zones(spark, sf_dir):
    table = workspace.fresh_path(spark, "seed")
    return lookup.seed_zones(spark, _zones_csv(spark, sf_dir), table)


@query
def union_available(spark, sf_dir):
    """The for-hire service has not landed; the others are unioned without it."""
    root = workspace.fresh_path(spark, "landing-metered")
    metered = fixture.tagged(spark, sf_dir, by_month=True).where(F.col("service") != "fhv")
    fixture.land(metered, root, as_dealt=True)
    present = landing.available_services(spark, root)
    return silver.union_trips([bronze.stage(raw, s, ids=False) for s, raw in present.items()])


@query
def source_counts(spark, sf_dir):
    relations = landing.available_services(spark, fixture.landed(spark, sf_dir))
    return landing.source_counts(relations | {"zones": fixture.raw_zones(spark, sf_dir)})


@query
def landing_gaps(spark, sf_dir):
    months = ("2024-01", "2024-02", "2024-03", "2024-04")
    return landing.landing_gaps(spark, fixture.landed(spark, sf_dir), months=months)


@query
def landing_summary(spark, sf_dir):
    """Files are known: one for each service and month; their bytes are not."""
    root = workspace.fresh_path(spark, "landing-files")
    fixture.by_month(fixture.tagged(spark, sf_dir)).write.partitionBy("service", "month").parquet(root)
    summary = landing.landing_summary(spark, root)
    return summary.select("files", (F.col("bytes") > 0).alias("has_bytes"))


@query
def catalog_listing(spark, sf_dir):
    root = fixture.landed(spark, sf_dir)
    catalog.create_namespaces(spark, workspace.fresh_path(spark, "catalog"), prefix="tripmart")
    database = catalog.namespace("raw")
    paths = {f"{s}_tripdata": f"{root}/service={s}_tripdata" for s in ("yellow", "green", "fhv")}
    catalog.register_files(spark, database, paths | {"nations": f"{sf_dir}/nation.parquet"})
    return catalog.list_tables(spark, database)


# Bronze ----------------------------------------------------------------------------------


@query
def stg_yellow(spark, sf_dir):
    return bronze.stage(fixture.raw(spark, sf_dir, "yellow"), "yellow")


@query
def stg_green(spark, sf_dir):
    return bronze.stage(fixture.raw(spark, sf_dir, "green"), "green")


@query
def stg_fhv(spark, sf_dir):
    return bronze.stage(fixture.raw(spark, sf_dir, "fhv"), "fhv")


@query
def stg_zones(spark, sf_dir):
    return fixture.zones(spark, sf_dir)


@query
def cast_round(spark, sf_dir):
    miles = F.col("trip_distance")
    return (
        fixture.tagged(spark, sf_dir)
        .groupBy(miles.alias("trip_distance"), rounded_int(miles).alias("whole_miles"))
        .agg(F.count(F.lit(1)).alias("trips"))
    )


@query
def trip_ids(spark, sf_dir):
    staged = bronze.stage_tagged(fixture.tagged(spark, sf_dir, spread=True))
    return staged.select("trip_id", "trip_type", "pickup_datetime", "tip_amount")


@query
def surrogate_ids(spark, sf_dir):
    trips = fixture.trips(spark, sf_dir).where(F.col("trip_type") == "yellow")
    numbered = with_surrogate_id(trips.select("trip_type", "pickup_datetime", "fare_amount"))
    return numbered.agg(
        F.count(F.lit(1)).alias("rows_in"), F.count_distinct("row_id").alias("distinct_ids")
    )


# Silver ----------------------------------------------------------------------------------


@query
def trips_unioned(spark, sf_dir):
    services = ("yellow", "green", "fhv")
    return silver.union_trips([bronze.stage(fixture.raw(spark, sf_dir, s), s) for s in services])


@query
def trip_duration(spark, sf_dir):
    return silver.with_duration(fixture.trips(spark, sf_dir)).select(
        "trip_type", "pickup_datetime", "dropoff_datetime", "trip_duration_minutes"
    )


@query
def avg_speed(spark, sf_dir):
    return silver.with_measures(fixture.trips(spark, sf_dir)).select(
        "trip_type", "trip_distance", "trip_duration_minutes", "avg_speed_mph"
    )


@query
def tip_percentage(spark, sf_dir):
    return silver.with_measures(fixture.trips(spark, sf_dir)).select(
        "trip_type", "fare_amount", "tip_amount", "tip_percentage"
    )


@query
def trips_enriched(spark, sf_dir):
    return fixture.enriched(spark, sf_dir, ids=True)


@query
def enriched_view(spark, sf_dir):
    """Enriched trips as another session reads them from the catalog, over stored bronze tables."""
    root, lake = fixture.landed(spark, sf_dir), jobs.Lake(workspace.fresh_path(spark, "lake"))
    jobs.build_bronze(spark, root, _zones_csv(spark, sf_dir), lake)
    jobs.publish_silver(spark, root, lake, "tripmart_view")
    return spark.newSession().table("tripmart_view_intermediate.int_trips_enriched")


def _passing(rule: str) -> Query:
    def passing(spark, sf_dir):
        trips = silver.with_measures(fixture.trips(spark, sf_dir))
        return trips.where(trip_rules()[rule]).select(*_RULE_COLUMNS)

    passing.__name__ = f"rule_{rule}"
    return passing


for _rule in ("duration", "fare", "distance", "speed", "zone"):
    query(_passing(_rule))


@query
def rejects_by_rule(spark, sf_dir):
    return silver.rejects_by_rule(silver.with_measures(fixture.trips(spark, sf_dir)))


@query
def trips_validated(spark, sf_dir):
    return fixture.validated(spark, sf_dir, ids=True)


@query
def spec_enriched(spark, sf_dir):
    staged = bronze.stage(fixture.raw(spark, sf_dir, "yellow"), "yellow", ids=False)
    return silver.enrich_yellow_simple(
        staged.select(
            "pickup_datetime",
            "dropoff_datetime",
            "pickup_zone_id",
            "dropoff_zone_id",
            "passenger_count",
            "trip_distance",
            "fare_amount",
            "tip_amount",
            "total_amount",
        ),
        fixture.zones(spark, sf_dir),
    )


# Gold ------------------------------------------------------------------------------------


@query
def dim_zones(spark, sf_dir):
    return gold.dim_zones(fixture.zones(spark, sf_dir))


@query
def decode_codes(spark, sf_dir):
    decoded = gold.decode_codes(fixture.trips(spark, sf_dir))
    codes = ["payment_type", "rate_code_id", "vendor_id"]
    labels = ["payment_label", "rate_label", "vendor_label"]
    return decoded.groupBy(*codes, *labels).agg(F.count(F.lit(1)).alias("trips"))


@query
def daily_trips(spark, sf_dir):
    return fixture.daily(spark, sf_dir)


@query
def pickup_metrics(spark, sf_dir):
    return gold.pickup_metrics(fixture.validated_without_zones(spark, sf_dir))


@query
def dropoff_metrics(spark, sf_dir):
    return gold.dropoff_metrics(fixture.validated_without_zones(spark, sf_dir))


@query
def zone_metrics(spark, sf_dir):
    return fixture.zone_fact(spark, sf_dir)


@query
def zone_metrics_join(spark, sf_dir):
    return gold.zone_metrics_joined(fixture.validated_without_zones(spark, sf_dir))


@query
def daily_summary(spark, sf_dir):
    return gold.daily_summary(fixture.daily(spark, sf_dir), dt.date(2024, 2, 15))


@query
def busiest_zones(spark, sf_dir):
    dimension = gold.dim_zones(fixture.zones(spark, sf_dir))
    return gold.busiest_zones(fixture.zone_fact(spark, sf_dir), dimension)


@query
def spec_daily(spark, sf_dir):
    return gold.daily_trips_simple(spec_enriched(spark, sf_dir))


# Incremental loads -----------------------------------------------------------------------

# The first load sees the first copy of every trip before this day, the second load all.
_FIRST_LOAD_BEFORE = "2024-03-01"


@query
def high_water_mark(spark, sf_dir):
    return upsert.high_water_mark(fixture.daily(spark, sf_dir), "trip_date")


@query
def lookback_slice(spark, sf_dir):
    trips = fixture.validated_without_zones(spark, sf_dir)
    start = upsert.lookback_start(fixture.daily(spark, sf_dir), "trip_date")
    return upsert.lookback_slice(trips, start).select(*_RULE_COLUMNS)


def _two_loads(spark, table: FactTable, first, everything, build, replace=False):
    load_increment(spark, table, first, build)
    return load_increment(spark, table, everything, build, replace=replace)


def _daily_loads(spark, sf_dir, replace):
    first = fixture.validated_pickups(spark, sf_dir, copies=False)
    return _two_loads(
        spark,
        daily_table(workspace.fresh_path(spark, "daily")),
        fixture.pickup_before(first, _FIRST_LOAD_BEFORE),
        fixture.validated_pickups(spark, sf_dir),
        gold.daily_trips,
        replace,
    )


@query
def incremental_daily(spark, sf_dir):
    return _daily_loads(spark, sf_dir, replace=False)


@query
def incremental_daily_replace(spark, sf_dir):
    return _daily_loads(spark, sf_dir, replace=True)


@query
def incremental_zone(spark, sf_dir):
    first = silver.validate(silver.with_measures(fixture.trips(spark, sf_dir, copies=False)))
    return _two_loads(
        spark,
        zone_table(workspace.fresh_path(spark, "zone")),
        fixture.pickup_before(first, _FIRST_LOAD_BEFORE),
        fixture.validated_without_zones(spark, sf_dir),
        gold.zone_metrics,
    )


# Quality ---------------------------------------------------------------------------------


def _report(spark, sf_dir, *kinds):
    """The checks of the trips, and of the facts, which are written first as several checks read them."""
    zones = fixture.zones(spark, sf_dir)
    facts: dict[str, DataFrame] = {}

    def write(name, frame):
        facts[name] = workspace.written(spark, frame, f"dq-{name}")

    found: list[DataFrame] = []
    workspace.together(
        spark,
        lambda: found.extend(
            suite.trip_report(
                fixture.trips(spark, sf_dir, ids=True), zones, kinds or None, without_ids=fixture.trips(spark, sf_dir)
            )
        ),
        lambda: write("daily", fixture.daily(spark, sf_dir)),
        lambda: write("zone", fixture.zone_fact(spark, sf_dir)),
    )
    found += suite.table_report(zones, gold.dim_zones(zones), facts["daily"], facts["zone"], kinds or None)
    return reduce(DataFrame.unionByName, found)


@query
def dq_report(spark, sf_dir):
    return _report(spark, sf_dir)


@query
def dq_stored(spark, sf_dir):
    """The checks of a stored lake: those of rows counted as the rows were written, ids by their hashes."""
    lake = workspace.fresh_path(spark, "lake")
    return jobs.run_all(spark, fixture.landed(spark, sf_dir), _zones_csv(spark, sf_dir), lake, stop=False)


@query
def dq_not_null(spark, sf_dir):
    return _report(spark, sf_dir, "not_null")


@query
def dq_unique(spark, sf_dir):
    return _report(spark, sf_dir, "unique")


@query
def dq_accepted_values(spark, sf_dir):
    return _report(spark, sf_dir, "accepted_values")


@query
def dq_accepted_range(spark, sf_dir):
    return _report(spark, sf_dir, "accepted_range")


@query
def dq_unique_key(spark, sf_dir):
    daily_key = [c for c in suite.daily_checks() if c.kind == "unique"]
    zone_key = [c for c in suite.zone_fact_checks() if c.kind == "unique"]
    return run_checks(fixture.daily(spark, sf_dir), daily_key).unionByName(
        run_checks(fixture.zone_fact(spark, sf_dir), zone_key)
    )


@query
def dq_metered_rules(spark, sf_dir):
    return run_checks(
        fixture.validated_without_zones(spark, sf_dir), suite.documented_checks()
    )


@query
def dq_relationships(spark, sf_dir):
    dimension = gold.dim_zones(fixture.zones(spark, sf_dir))
    return missing_references(fixture.zone_fact(spark, sf_dir), dimension, "zone_id")


@query
def schema_contract(spark, sf_dir):
    """All models against their contracts; the models of the trip stream share one pass."""
    zones = fixture.zones(spark, sf_dir)
    staged = bronze.stage_tagged(fixture.tagged(spark, sf_dir))
    enriched = silver.enrich(staged, zones)
    actual = {
        f"stg_{s}_trips": bronze.stage(fixture.raw(spark, sf_dir, s), s).schema
        for s in ("yellow", "green", "fhv")
    }
    actual["int_trips_unioned"] = silver.conform(staged).schema
    actual["int_trips_enriched"] = silver.enrich(silver.conform(staged), zones).schema
    actual["int_trips_validated"] = actual["int_trips_enriched"]
    trips = {model: (CONTRACTS[model], schema) for model, schema in actual.items()}
    occurs = enriched.withColumn("occurs", F.lit(1))
    report = contract_profile(occurs, trips, suite.trip_weights())
    for model, frame in {
        "stg_taxi_zones": zones,
        "dim_zones": gold.dim_zones(zones),
        "fct_daily_trips": fixture.daily(spark, sf_dir),
        "fct_zone_metrics": fixture.zone_fact(spark, sf_dir),
    }.items():
        profile = contract_profile(frame, {model: (CONTRACTS[model], frame.schema)})
        report = report.unionByName(profile)
    return report


# Streams ---------------------------------------------------------------------------------


def _land_in_two_waves(spark, sf_dir):
    """Roots of a landing and a function that lands the next wave into it.

    The first wave holds January and February, the second March.
    """
    root = workspace.fresh_path(spark, "landing-waves")
    records = fixture.tagged(spark, sf_dir)
    pickup = F.coalesce("tpep_pickup_datetime", "lpep_pickup_datetime", "pickup_datetime")
    early = F.coalesce(pickup < F.expr("timestamp_ntz'2024-03-01 00:00:00'"), F.lit(True))
    waves = [records.where(early), records.where(~early)]
    return root, [lambda w=wave: fixture.land(w, root, mode="append") for wave in waves]


@query
def ingest_new_files(spark, sf_dir):
    root, waves = _land_in_two_waves(spark, sf_dir)
    table = workspace.fresh_path(spark, "ingested")
    checkpoint = workspace.fresh_path(spark, "ingested-progress")
    for land_next in waves:
        land_next()
        ingest.ingest_new_files(ingest.landed_trips(spark, root), table, checkpoint)
    return spark.read.parquet(table)


@query
def stream_daily(spark, sf_dir):
    root, waves = _land_in_two_waves(spark, sf_dir)
    table = daily_table(workspace.fresh_path(spark, "stream-daily"))
    silver_path = workspace.fresh_path(spark, "stream-silver")
    checkpoint = workspace.fresh_path(spark, "stream-daily-progress")
    zones = fixture.zones(spark, sf_dir)
    for land_next in waves:
        land_next()
        daily.stream_daily(spark, root, zones, silver_path, table, checkpoint)
    return read_fact(spark, table)


@query
def stream_daily_counts(spark, sf_dir):
    source = f"{sf_dir}/{{events}}.parquet"
    schema = spark.read.parquet(source).schema
    events = spark.readStream.schema(schema).parquet(source)
    table = workspace.fresh_path(spark, "closed-days")
    counts.run_daily_counts(
        counts.daily_counts(events, "ts", ["event_type"]),
        table,
        workspace.fresh_path(spark, "closed-days-progress"),
    )
    return spark.read.parquet(table)
