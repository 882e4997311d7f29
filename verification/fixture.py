"""Trip records derived from the driver's tables.

The driver has no trips, so every lineitem becomes one trip (some become two, as exact-key
copies) and the nations become zones. All rules are integer arithmetic that both engines
evaluate alike; ``verification/oracles.py`` states the same rules in SQL.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import workspace
from tripmart.plans import bronze, gold, silver
from tripmart.schemas import tagged_raw_schema
from tripmart.sources import landing

_LINE = "cast(l_linenumber as bigint)"
_PICKUP_S = f"(l_orderkey * 7919 + {_LINE} * 104729 + l_partkey * 31) % 7862400"
_DUR_S = f"((l_partkey * 37 + l_suppkey * 101 + {_LINE} * 13) % 13000 - 400)"
_START = "timestamp_ntz'2024-01-01 00:00:00'"
_PICKUP = f"if(l_orderkey % 211 <> 0, {_START} + interval '1' second * ({_PICKUP_S}), null)"
_DROPOFF = (
    "if(l_returnflag = 'N' and l_orderkey % 97 = 0, null,"
    f" {_START} + interval '1' second * ({_PICKUP_S} + {_DUR_S}))"
)
_METERED = "l_returnflag in ('A', 'R')"
_FARE = "floor(l_extendedprice) / 100.0D * if(l_orderkey % 53 = 0, -1.0D, 1.0D)"
_TIP = f"l_discount * ({_FARE}) + if(dupe = 1, 1.0D, 0.0D)"
_EXTRA = f"{_LINE} % 3 * 0.5D"
_TOLLS = "l_tax * 10.0D"

# Raw column -> formula for metered trips; null for the others.
_METERED_VALUES = {
    "VendorID": f"{_LINE} % 3 + 1",
    "passenger_count": _LINE,
    "trip_distance": (
        "case when l_orderkey % 59 = 0 then 250.0D when l_orderkey % 61 = 0 then 0.0D"
        " else l_quantity * 0.5D end"
    ),
    "RatecodeID": f"{_LINE} % 7 + 1",
    "store_and_fwd_flag": "if(l_linestatus = 'F', 'Y', 'N')",
    "payment_type": "l_suppkey % 7",
    "fare_amount": _FARE,
    "extra": _EXTRA,
    "mta_tax": "0.5D",
    "improvement_surcharge": "0.3D",
    "tip_amount": _TIP,
    "tolls_amount": _TOLLS,
    "total_amount": f"({_FARE}) + ({_TIP}) + ({_EXTRA}) + 0.5D + 0.3D + {_TOLLS}",
}
_VALUES = {
    "service": "case l_returnflag when 'A' then 'yellow' when 'R' then 'green'"
    " when 'N' then 'fhv' end",
    **{name: f"if({_METERED}, {value}, null)" for name, value in _METERED_VALUES.items()},
    "PULocationID": "if(l_partkey % 89 <> 0, case l_suppkey % 28 when 25 then 264"
    " when 26 then 265 when 27 then 999 else l_suppkey % 28 end, null)",
    "DOLocationID": "case l_partkey % 28 when 25 then 264 when 26 then 265 when 27 then 999"
    " else l_partkey % 28 end",
    "trip_type": f"if(l_returnflag = 'R', {_LINE} % 2 + 1, null)",
    "dispatching_base_num": "if(l_returnflag = 'N', concat('B', l_suppkey), null)",
    "Affiliated_base_number": (
        "if(l_returnflag = 'N' and l_partkey % 5 <> 0, concat('B', l_partkey), null)"
    ),
    "SR_Flag": f"if(l_returnflag = 'N', case {_LINE} % 3 when 0 then 1 when 1 then 0 end, null)",
}
_LINE_COLUMNS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
)
_FLAG_OF_SERVICE = {"yellow": "A", "green": "R", "fhv": "N"}
_TIMES_OF_FLAG = {
    "A": ("tpep_pickup_datetime", "tpep_dropoff_datetime"),
    "R": ("lpep_pickup_datetime", "lpep_dropoff_datetime"),
    "N": ("pickup_datetime", "dropOff_datetime"),
}


_PLANS: dict[tuple, DataFrame] = {}


def _once(build):
    """Plans are composed once per session, like views; the rows are read each time."""

    @wraps(build)
    def found(spark: SparkSession, sf_dir: str, *args, **options) -> DataFrame:
        key = (build.__name__, spark.sparkContext.applicationId, id(spark), sf_dir, args, tuple(sorted(options.items())))
        if key not in _PLANS:
            _PLANS[key] = build(spark, sf_dir, *args, **options)
        return _PLANS[key]

    return found


def _spread(rows: DataFrame) -> DataFrame:
    """Rows of fewer splits than cores, such as a file of one row group, dealt over all of them."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def _dealt(rows: DataFrame) -> DataFrame:
    """Line items dealt by the service and month of the records they become, which are three times as wide."""
    known = " or ".join(f"l_returnflag = '{flag}'" for flag in _TIMES_OF_FLAG)
    month = F.expr(f"coalesce(substring(cast(if({known}, {_PICKUP}, null) as string), 1, 7), '2024-01')")
    return landing.dealt(rows, F.col("l_returnflag"), month, [F.col("l_orderkey"), F.col("l_linenumber")])


def _timed(
    spark: SparkSession, sf_dir: str, copies: bool, service: str | None, spread: bool, by_month: bool
) -> DataFrame:
    """Line items with the times of their service, one row per trip.

    With ``copies`` those of every fiftieth order appear twice, the second time as ``dupe``
    1. The times leave a generator, so they are columns like those of a file: a filter on
    them is not pushed below, where their formulas would be repeated at every mention.
    """
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    if spread:
        rows = _spread(rows.select(*_LINE_COLUMNS))
    if service:
        rows = rows.where(F.col("l_returnflag") == _FLAG_OF_SERVICE[service])
    if by_month:
        rows = _dealt(rows.select(*_LINE_COLUMNS))
    times = ", ".join(
        f"'{name}', if(l_returnflag = '{flag}', {moment}, null)"
        for flag, names in _TIMES_OF_FLAG.items()
        for name, moment in zip(names, (_PICKUP, _DROPOFF), strict=True)
    )
    timed = rows.selectExpr("*", f"inline(array(named_struct({times})))")
    dupes = "if(l_orderkey % 50 = 7, array(0, 1), array(0))" if copies else "array(0)"
    return timed.selectExpr("*", f"explode({dupes}) as dupe")


@_once
def tagged(
    spark: SparkSession,
    sf_dir: str,
    copies: bool = True,
    service: str | None = None,
    spread: bool = False,
    by_month: bool = False,
) -> DataFrame:
    """Raw records of the three services (or one) in one relation, tagged by ``service``.

    With ``spread`` a file of few splits is dealt over all cores first, for what costs much per row; with
    ``by_month`` line items are dealt as the landing wants its rows.
    """
    columns = (
        f"cast({_VALUES.get(f.name, f.name)} as {f.dataType.simpleString()}) as {f.name}"
        for f in tagged_raw_schema().fields
    )
    return _timed(spark, sf_dir, copies, service, spread, by_month).selectExpr(*columns)


@_once
def raw(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    """Raw records of one service, as its own files would hold them."""
    return bronze.raw_columns(tagged(spark, sf_dir, service=service), service)


@_once
def raw_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup: one zone per nation and the two sentinels."""
    zones = spark.read.parquet(f"{sf_dir}/nation.parquet").selectExpr(
        "cast(n_nationkey as int) as LocationID",
        "case when n_nationkey = 24 then 'EWR' when n_regionkey = 0 then 'Manhattan'"
        " when n_regionkey = 1 then 'Brooklyn' when n_regionkey = 2 then 'Queens'"
        " when n_regionkey = 3 then 'Bronx' else 'Staten Island' end as Borough",
        "case when n_nationkey = 24 then 'Newark Airport'"
        " when n_nationkey in (7, 12) then concat(n_name, ' Airport') else n_name end as Zone",
        "case when n_nationkey = 24 then 'EWR' when n_nationkey in (7, 12) then 'Airports'"
        " when n_regionkey = 0 then 'Yellow Zone' else 'Boro Zone' end as service_zone",
    )
    sentinels = spark.sql(
        "VALUES (264, 'Unknown', 'N/A', 'N/A'), (265, 'N/A', 'Outside of NYC', 'N/A')"
    )
    return zones.union(sentinels)


@_once
def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.stage_zones(raw_zones(spark, sf_dir))


@_once
def trips(
    spark: SparkSession, sf_dir: str, ids: bool = False, copies: bool = True
) -> DataFrame:
    """Conformed trips of all services from one scan."""
    return silver.conform(bronze.stage_tagged(tagged(spark, sf_dir, copies, spread=ids), ids))


@_once
def enriched(
    spark: SparkSession, sf_dir: str, ids: bool = False, copies: bool = True
) -> DataFrame:
    return silver.enrich(trips(spark, sf_dir, ids, copies), zones(spark, sf_dir))


@_once
def validated(
    spark: SparkSession, sf_dir: str, ids: bool = False, copies: bool = True
) -> DataFrame:
    return silver.validate(enriched(spark, sf_dir, ids, copies))


@_once
def validated_without_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated trips for consumers that use zone ids only; needs no lookup at all."""
    return silver.validate(silver.with_measures(trips(spark, sf_dir)))


@_once
def validated_pickups(spark: SparkSession, sf_dir: str, copies: bool = True) -> DataFrame:
    """Validated trips for the daily fact, which uses the pickup zone only."""
    plain = trips(spark, sf_dir, copies=copies)
    return silver.validate(silver.enrich(plain, zones(spark, sf_dir), roles=("pickup",)))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.daily_trips(validated_pickups(spark, sf_dir))


def zone_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.zone_metrics(validated_without_zones(spark, sf_dir))


def _pickup_month() -> Column:
    pickup = F.coalesce("tpep_pickup_datetime", "lpep_pickup_datetime", "pickup_datetime")
    # Records without a pickup time still lie in some file of their service.
    return F.coalesce(F.substring(pickup.cast("string"), 1, 7), F.lit("2024-01"))


def land(records: DataFrame, root: str, mode: str = "overwrite", as_dealt: bool = False) -> None:
    landing.land(records, root, _pickup_month(), mode, as_dealt)


def by_month(records: DataFrame) -> DataFrame:
    """Records as one task and file for each service and month, with the landing's folder columns."""
    named = records.withColumn("service", F.concat("service", F.lit("_tripdata"))).withColumn("month", _pickup_month())
    return named.repartition("service", "month")


_LANDED: dict[tuple[str, str], str] = {}


def landed(spark: SparkSession, sf_dir: str) -> str:
    """Root of the landed files of all services; written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LANDED:
        root = workspace.fresh_path(spark, "landing")
        land(tagged(spark, sf_dir, by_month=True), root, as_dealt=True)
        _LANDED[key] = root
    return _LANDED[key]


def pickup_before(records: DataFrame, day: str) -> DataFrame:
    return records.where(F.col("pickup_datetime") < F.expr(f"timestamp_ntz'{day} 00:00:00'"))


