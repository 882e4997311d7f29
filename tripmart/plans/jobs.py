"""Jobs that build the layers on storage."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import storage, workspace
from tripmart.config import DEFAULT_RULES, SERVICES, Rules, shuffle_settings
from tripmart.functions.time import day_of
from tripmart.operators.lock import writing
from tripmart.operators.proofs import Proofs
from tripmart.operators.refresh import current_path, read_current, refresh
from tripmart.operators.upsert import (
    daily_table,
    load_increment,
    lookback_slice,
    lookback_start,
    read_fact,
    recover,
    zone_table,
)
from tripmart.plans import bronze, gold, silver, suite
from tripmart.schemas import CONTRACTS
from tripmart.sources import catalog, landing, lookup
from tripmart.sources.footers import footers, stored_contract


# Bytes that numbering shuffles for each byte of the landed, compressed files.
_STAGED_PER_LANDED = 4

# Sentinel zones appear as dropoffs in the zone fact, which the dimension leaves out.
KNOWN_FAILURES = ("relationships",)


@dataclass(frozen=True)
class Lake:
    """Paths of the tables of one deployment."""

    root: str

    def table(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def proofs(self, spark: SparkSession) -> Proofs:
        return Proofs(spark, f"{self.root}/_proofs.json")


def _write_by_day(trips: DataFrame, path: str, since: dt.date | None, dealt: bool = False) -> None:
    """Write trips partitioned by pickup day; with ``since`` earlier days are kept.

    Rebalancing by day keeps one task from writing a sliver of every day, and AQE splits a
    day that holds far more rows than the others. Trips that are read from files by day are
    ``dealt`` already: each task then writes the days of the files it reads.
    """
    by_day = trips.withColumn("pickup_date", day_of(F.col("pickup_datetime")))
    (
        (by_day if dealt else by_day.hint("rebalance", "pickup_date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if since else "static")
        .partitionBy("pickup_date")
        .parquet(path)
    )


def build_bronze(
    spark: SparkSession,
    landing_root: str,
    zones_csv: str,
    lake: Lake,
    since: dt.date | None = None,
) -> None:
    """Seed, staged zones and one table of staged trips per landed service."""
    seed = lookup.seed_zones(spark, zones_csv, lake.table("seeds", "taxi_zones"))
    refresh(spark, bronze.stage_zones(seed), lake.table("staging", "stg_taxi_zones"))
    for service, raw in landing.available_services(spark, landing_root).items():
        table = lake.table("staging", f"stg_{service}_trips")
        staged = bronze.stage(raw, service, since=since, by_day=True)
        checks = suite.row_checks(f"stg_{service}_trips", "int_trips_unioned", "int_trips_enriched")
        lake.proofs(spark).write(
            table, staged, checks, lambda rows, path=table: _write_by_day(rows, path, since, dealt=True), whole=since is None
        )


def read_bronze(spark: SparkSession, lake: Lake, services: list[str]) -> DataFrame:
    """Union of the staged services, with their partition day."""
    staged = [spark.read.parquet(lake.table("staging", f"stg_{s}_trips")) for s in services]
    return silver.union_trips(staged, extra=["pickup_date"])


def build_silver(
    spark: SparkSession,
    lake: Lake,
    services: list[str],
    rules: Rules = DEFAULT_RULES,
    since: dt.date | None = None,
) -> None:
    """Validated trips, written once because both facts read them."""
    zones = read_current(spark, lake.table("staging", "stg_taxi_zones"))
    trips = lookback_slice(read_bronze(spark, lake, services), since).drop("pickup_date")
    valid = silver.validate(silver.enrich(trips, zones), rules)
    table = lake.table("intermediate", "int_trips_validated")
    checks = suite.row_checks("int_trips_validated", rules=rules)
    lake.proofs(spark).write(
        table, valid, checks, lambda rows: _write_by_day(rows, table, since, dealt=True), whole=since is None
    )


def build_gold(
    spark: SparkSession,
    lake: Lake,
    rules: Rules = DEFAULT_RULES,
    max_event_date: dt.date | None = None,
) -> None:
    """Dimension in full; facts in full on the first run, afterwards incrementally."""
    zones = read_current(spark, lake.table("staging", "stg_taxi_zones"))
    refresh(spark, gold.dim_zones(zones, rules), lake.table("marts", "dim_zones"))
    validated = spark.read.parquet(lake.table("intermediate", "int_trips_validated"))
    for table, build in (
        (daily_table(lake.table("marts", "fct_daily_trips")), gold.daily_trips),
        (zone_table(lake.table("marts", "fct_zone_metrics")), gold.zone_metrics),
    ):
        load_increment(spark, table, validated, build, rules, max_event_date=max_event_date)


def proven_checks(spark: SparkSession, lake: Lake, services: list[str]) -> set[tuple[str, str, str]]:
    """Checks that were counted without a failure when the rows now stored were written.

    What holds in the staged table of every service holds in their union, and in the enriched trips,
    which only repeat these rows. A service that hasn't landed has no row to fail.
    """
    proofs = lake.proofs(spark)
    staged = [proofs.held(lake.table("staging", f"stg_{s}_trips")) for s in services]
    shared = set.intersection(*staged) if staged else set()
    held = set().union(*staged)
    held = {name for name in held if name[0].startswith("stg_")} | shared
    absent = (f"stg_{s}_trips" for s in SERVICES if s not in services)
    held |= {check.name for check in suite.row_checks(*absent)}
    return held | proofs.held(lake.table("intermediate", "int_trips_validated"))


def check_quality(
    spark: SparkSession, lake: Lake, services: list[str], rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """All checks on the stored tables; those that were counted as the rows were written take no scan."""
    return suite.quality_report(
        read_bronze(spark, lake, services),
        read_current(spark, lake.table("staging", "stg_taxi_zones")),
        read_current(spark, lake.table("marts", "dim_zones")),
        spark.read.parquet(lake.table("marts", "fct_daily_trips")),
        spark.read.parquet(lake.table("marts", "fct_zone_metrics")),
        rules=rules,
        validated=spark.read.parquet(lake.table("intermediate", "int_trips_validated")),
        proven=proven_checks(spark, lake, services),
    )


def check_contracts(spark: SparkSession, lake: Lake, services: list[str]) -> DataFrame:
    """What the files of every stored table hold against its contract, by their footers.

    A partition's day is in the folder's name and in no file, so it is left out.
    """
    tables = {f"stg_{s}_trips": lake.table("staging", f"stg_{s}_trips") for s in services}
    tables["int_trips_validated"] = lake.table("intermediate", "int_trips_validated")
    tables |= {name: lake.table("marts", name) for name in ("fct_daily_trips", "fct_zone_metrics")}
    for layer, name in (("staging", "stg_taxi_zones"), ("marts", "dim_zones")):
        tables[name] = current_path(spark, lake.table(layer, name))
    days = {"fct_daily_trips": "trip_date", "fct_zone_metrics": "metric_date"}
    reports = []
    for model, path in sorted(tables.items()):
        expected = {f.name: f.dataType.simpleString() for f in CONTRACTS[model].fields if f.name != days.get(model)}
        profile = footers(landing.landed_files(spark, path))
        reports.append(stored_contract(profile, expected).withColumn("model", F.lit(model)))
    return reduce(DataFrame.unionByName, reports)


class QualityError(RuntimeError):
    """Declared checks failed; the message lists them."""


def require_quality(report: DataFrame, known: tuple[str, ...] = KNOWN_FAILURES) -> None:
    """Raise if any check but those of the ``known`` kinds has failures."""
    failed = report.where(F.col("failures") > 0).where(~F.col("check_name").isin(*known)).collect()
    if failed:
        raise QualityError("; ".join(f"{r.model}.{r.column_name} {r.check_name}: {r.failures}" for r in failed))


class LandingGaps(RuntimeError):
    """Expected files haven't landed; the message lists service and month."""


def require_landed(spark: SparkSession, landing_root: str, months: tuple[str, ...]) -> None:
    """Raise if a service lacks a file of one of the months."""
    gaps = landing.landing_gaps(spark, landing_root, months=months).orderBy("service", "month").collect()
    if gaps:
        raise LandingGaps(", ".join(f"{r['service']} {r['month']}" for r in gaps))


def publish(spark: SparkSession, landing_root: str, lake: Lake, prefix: str = "") -> None:
    """Expose sources and tables by layer, so that SQL can name them: ``marts.dim_zones``.

    Without a prefix the namespaces are called ``raw``, ``staging``, ``intermediate``,
    ``marts`` and ``seeds``. The raw zones are a view of the seed, the union one of the staged
    tables, and the enriched trips one of the union and the staged zones; every session that shares the
    catalog reads them. Tables that are built in versions show the one current now.
    """
    services = publish_silver(spark, landing_root, lake, prefix)
    raw_paths = {f"{s}_tripdata": landing.service_glob(landing_root, s) for s in services}
    catalog.register_files(spark, catalog.namespace("raw", prefix), raw_paths)
    tables = {
        "seeds": ["taxi_zones"],
        "intermediate": ["int_trips_validated"],
        "marts": ["dim_zones", "fct_daily_trips", "fct_zone_metrics"],
    }
    for layer, names in tables.items():
        _register(spark, lake, layer, names, prefix)
    raw, seeds = catalog.namespace("raw", prefix), catalog.namespace("seeds", prefix)
    spark.sql(f"CREATE OR REPLACE VIEW {raw}.taxi_zones AS SELECT * FROM {seeds}.taxi_zones")


def _register(spark: SparkSession, lake: Lake, layer: str, names: list[str], prefix: str) -> None:
    paths = {name: current_path(spark, lake.table(layer, name)) for name in names}
    catalog.register_files(spark, catalog.namespace(layer, prefix), paths)


def publish_silver(spark: SparkSession, landing_root: str, lake: Lake, prefix: str = "") -> list[str]:
    """Expose the staged tables, their union and the enriched trips; the services that there are."""
    catalog.create_namespaces(spark, lake.root, prefix)
    services = landing.landed_services(spark, landing_root)
    _register(spark, lake, "staging", ["stg_taxi_zones", *(f"stg_{s}_trips" for s in services)], prefix)
    staging = catalog.namespace("staging", prefix)
    parts = [_common_columns(spark, f"{staging}.stg_{s}_trips") for s in services]
    view = f"{catalog.namespace('intermediate', prefix)}.int_trips_unioned"
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {' UNION ALL '.join(parts)}")
    enriched = f"{catalog.namespace('intermediate', prefix)}.int_trips_enriched"
    spark.sql(
        f"CREATE OR REPLACE VIEW {enriched} AS {silver.enrichment_sql(view, f'{staging}.stg_taxi_zones')}"
    )
    return services


def _common_columns(spark: SparkSession, table: str) -> str:
    """A staged service with the columns of the union; what it lacks is null."""
    there = set(spark.table(table).columns)
    columns = (
        f.name if f.name in there else f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}"
        for f in CONTRACTS["int_trips_unioned"].fields
    )
    return f"SELECT {', '.join(columns)} FROM {table}"


def register_views(
    spark: SparkSession, landing_root: str, zones: DataFrame, rules: Rules = DEFAULT_RULES
) -> None:
    """Bronze and silver as session views over the landing, recomputed on every read."""
    staged = {
        service: bronze.stage(raw, service)
        for service, raw in landing.available_services(spark, landing_root).items()
    }
    unioned = silver.union_trips(list(staged.values()))
    enriched = silver.enrich(unioned, zones)
    views = {f"stg_{service}_trips": frame for service, frame in staged.items()}
    views |= {
        "stg_taxi_zones": zones,
        "int_trips_unioned": unioned,
        "int_trips_enriched": enriched,
        "int_trips_validated": silver.validate(enriched, rules),
    }
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)


def _size_shuffles(spark: SparkSession, landing_root: str) -> None:
    """Raise the number of shuffle partitions if the landed files call for more than there are."""
    landed = landing.landing_summary(spark, landing_root).first()["bytes"]
    wanted = shuffle_settings(landed * _STAGED_PER_LANDED)
    setting = "spark.sql.shuffle.partitions"
    if landed * _STAGED_PER_LANDED > int(spark.conf.get(setting)) << 30:
        spark.conf.set(setting, wanted[setting])


def _lookback(
    spark: SparkSession, lake: Lake, rules: Rules, max_event_date: dt.date | None
) -> dt.date | None:
    """First day that a run recomputes in either fact; None if one has to be loaded in full."""
    facts = (
        daily_table(lake.table("marts", "fct_daily_trips")),
        zone_table(lake.table("marts", "fct_zone_metrics")),
    )
    for table in facts:
        with writing(spark, table.path):
            recover(spark, table)
    starts = [lookback_start(read_fact(spark, t), t.day, rules, max_event_date) for t in facts]
    return None if None in starts else min(starts)


def _staged_files(spark: SparkSession, lake: Lake) -> DataFrame | None:
    """The files that bronze and silver hold; None without a list."""
    return read_current(spark, lake.table("staging", "_landed_files"))


def _unstaged(
    spark: SparkSession, lake: Lake, services: list[str], listing: DataFrame
) -> dict[str, dt.date | None] | None:
    """Per service with files that aren't staged yet, their first pickup day.

    None asks for all days: there is no list of staged files, or one of them has gone or was written
    anew, so that its days aren't known any more. All files of a service without a table are new.
    """
    staged = _staged_files(spark, lake)
    if staged is None:
        return None
    missing = [s for s in services if not storage.exists(spark, lake.table("staging", f"stg_{s}_trips"))]
    if not staged.join(listing, listing.columns, "left_anti").isEmpty():
        return None
    known = staged.where(~F.col("service").isin(missing)) if missing else staged
    fresh = workspace.written(spark, listing.join(known, listing.columns, "left_anti"), "unstaged")
    services_ = [r["service"] for r in fresh.select("service").distinct().collect()]
    return {s: landing.earliest_pickup(spark, s, fresh.where(F.col("service") == s)) for s in services_}


def _note_staged(
    spark: SparkSession, lake: Lake, listing: DataFrame, left_out: list[str]
) -> None:
    """List the files as staged; of services that are left out only those listed before."""
    held = listing.where(~F.col("service").isin(left_out)) if left_out else listing
    before = _staged_files(spark, lake) if left_out else None
    if before is not None:
        held = held.unionByName(before.where(F.col("service").isin(left_out)))
    refresh(spark, held, lake.table("staging", "_landed_files"))


def run_all(
    spark: SparkSession,
    landing_root: str,
    zones_csv: str,
    lake_root: str,
    rules: Rules = DEFAULT_RULES,
    since: dt.date | None = None,
    max_event_date: dt.date | None = None,
    stop: bool = True,
    full: bool = False,
    prefix: str | None = None,
    months: tuple[str, ...] = (),
) -> DataFrame:
    """Build every layer from the landing and return the quality report.

    The report is written first; with ``stop`` a failed check, other than the known ones, raises. With
    ``prefix`` the catalog's views are switched to what was built, before the checks are judged. One run at a
    time works on a lake. With ``months`` nothing is built while a service lacks the file of one of them
    (``LandingGaps`` names these).

    A later run upserts the days within the lookback into the facts, and rebuilds bronze and
    silver for the days from ``since`` on only, by default those of the lookback and from the first
    pickup day on of files that aren't staged yet (a list of staged files lies beside bronze): the bound
    reaches the scans of the landed files, and trip ids number the copies within one pickup
    second, so whole days can be replaced on their own. ``full`` rebuilds all days.
    """
    if months:
        require_landed(spark, landing_root, months)
    lake = Lake(lake_root.rstrip("/"))
    with writing(spark, f"{lake.root}/_run"):
        report = _run_all(spark, landing_root, zones_csv, lake, rules, since, max_event_date, full)
        if prefix is not None:
            publish(spark, landing_root, lake, prefix)
    if stop:
        require_quality(report)
    return report


def _run_all(
    spark: SparkSession,
    landing_root: str,
    zones_csv: str,
    lake: Lake,
    rules: Rules,
    since: dt.date | None,
    max_event_date: dt.date | None,
    full: bool,
) -> DataFrame:
    _size_shuffles(spark, landing_root)
    services = landing.landed_services(spark, landing_root)
    listing = workspace.written(spark, landing.file_listing(spark, landing_root), "listing")
    unstaged = None if full else _unstaged(spark, lake, services, listing)
    firsts = {service: day for service, day in (unstaged or {}).items() if day is not None}
    left_out: list[str] = []
    if since is None and not full and unstaged is not None:
        start = _lookback(spark, lake, rules, max_event_date)
        since = None if start is None else min([start, *firsts.values()])
    elif since is not None:
        # Files with earlier days aren't staged in whole; without a list any file may be such a one.
        left_out = services if unstaged is None else [s for s, day in firsts.items() if day < since]
    build_bronze(spark, landing_root, zones_csv, lake, since)
    build_silver(spark, lake, services, rules, since)
    _note_staged(spark, lake, listing, left_out)
    build_gold(spark, lake, rules, max_event_date)
    return refresh(spark, check_quality(spark, lake, services, rules), lake.table("marts", "quality_report"))
