"""Silver: union, enrichment and validation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.config import DEFAULT_RULES, Rules
from tripmart.functions.numeric import speed_mph, speed_sql, tip_percentage, tip_sql
from tripmart.functions.time import minutes_between, minutes_sql
from tripmart.operators.rules import trip_rules
from tripmart.schemas import COMMON_TRIP_COLUMNS, CONTRACTS


def conform(staged: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Keep the columns every service shares (``trip_id`` only where it was built)."""
    shared = [*COMMON_TRIP_COLUMNS, *extra]
    return staged.select(*(c for c in shared if c in staged.columns))


def union_trips(staged: list[DataFrame], extra: Sequence[str] = ()) -> DataFrame:
    """All services in one shape; columns a service lacks are null of its peers' type.

    The columns come out in the common order even where no metered service has landed.
    """
    conformed = [conform(s, extra) for s in staged]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), conformed)
    types = {f.name: f.dataType for f in CONTRACTS["int_trips_unioned"].fields}
    optional = {"trip_id"} - set(union.columns)
    return union.select(
        *(
            F.col(c) if c in union.columns else F.lit(None).cast(types[c]).alias(c)
            for c in COMMON_TRIP_COLUMNS
            if c not in optional
        ),
        *extra,
    )


def with_duration(trips: DataFrame) -> DataFrame:
    return trips.withColumn(
        "trip_duration_minutes",
        minutes_between(F.col("pickup_datetime"), F.col("dropoff_datetime")),
    )


def with_measures(trips: DataFrame) -> DataFrame:
    """Duration, speed and tip share: all that validation and the zone fact need."""
    return with_duration(trips).withColumns(
        {
            "avg_speed_mph": speed_mph(F.col("trip_distance"), F.col("trip_duration_minutes")),
            "tip_percentage": tip_percentage(F.col("tip_amount"), F.col("fare_amount")),
        }
    )


def _zone_role(zones: DataFrame, role: str) -> DataFrame:
    return zones.select(
        F.col("zone_id").alias(f"{role}_zone_id"),
        F.col("zone_name").alias(f"{role}_zone_name"),
        F.col("borough").alias(f"{role}_borough"),
        F.col("service_zone").alias(f"{role}_service_zone"),
    )


def with_zones(
    trips: DataFrame, zones: DataFrame, roles: Sequence[str] = ("pickup", "dropoff")
) -> DataFrame:
    """Look the zone up in each role, as pickup and as dropoff.

    No broadcast hint: Catalyst broadcasts the lookup while its estimated size is below
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise falls back to a sort-merge join,
    whose hot zones AQE splits.
    """
    looked_up = trips
    for role in roles:
        looked_up = looked_up.join(_zone_role(zones, role), f"{role}_zone_id", "left")
    added = [
        f"{role}_{column}"
        for role in roles
        for column in ("zone_name", "borough", "service_zone")
    ]
    return looked_up.select(*trips.columns, *added)


def enrich(
    trips: DataFrame, zones: DataFrame, roles: Sequence[str] = ("pickup", "dropoff")
) -> DataFrame:
    """Add zone attributes and measures.

    A consumer that reads only one role can leave the other lookup out; zone ids are
    unique, so no rows depend on it.
    """
    return with_measures(with_zones(trips, zones, roles))


def enrichment_sql(trips: str, zones: str) -> str:
    """``enrich`` as text over two named relations, for views that a catalog keeps.

    A catalog stores a view as SQL; the expressions here state those of ``with_measures`` and ``with_zones``.
    """
    minutes = minutes_sql("t.pickup_datetime", "t.dropoff_datetime")
    roles = {"pickup": "p", "dropoff": "d"}
    names = (
        f"{name}.{column} AS {role}_{column}"
        for role, name in roles.items()
        for column in ("zone_name", "borough", "service_zone")
    )
    return f"""
        SELECT t.* EXCEPT (minutes), {", ".join(names)}, t.minutes AS trip_duration_minutes,
               {speed_sql("t.trip_distance", "t.minutes")} AS avg_speed_mph,
               {tip_sql("t.tip_amount", "t.fare_amount")} AS tip_percentage
        FROM (SELECT t.*, {minutes} AS minutes FROM {trips} t) t
        LEFT JOIN {zones} p ON p.zone_id = t.pickup_zone_id
        LEFT JOIN {zones} d ON d.zone_id = t.dropoff_zone_id"""


def validate(trips: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Rows that pass every rule; a rule that is null rejects the row."""
    passed = reduce(lambda a, b: a & b, trip_rules(rules).values())
    return trips.where(passed)


def rejects_by_rule(trips: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Per service: trips seen, rejected by each rule, rejected by any."""
    failed = {n: ~F.coalesce(r, F.lit(False)) for n, r in trip_rules(rules).items()}
    rejected = reduce(lambda a, b: a | b, failed.values())
    return trips.groupBy("trip_type").agg(
        F.count(F.lit(1)).alias("trips"),
        *(F.count_if(test).alias(f"failed_{name}") for name, test in failed.items()),
        F.count_if(rejected).alias("rejected"),
    )


def enrich_yellow_simple(
    staged: DataFrame, zones: DataFrame, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """The simpler design variant: zone names and boroughs, speed 0 without distance."""
    joined = with_duration(with_zones(staged, zones)).drop(
        "pickup_service_zone", "dropoff_service_zone"
    )
    minutes = F.col("trip_duration_minutes")
    hours = minutes / F.lit(60.0)
    speed = F.when(F.col("trip_distance") > 0, F.try_divide("trip_distance", hours))
    return joined.withColumn("avg_speed_mph", speed.otherwise(F.lit(0.0))).where(
        (minutes > 0) & (minutes < rules.max_minutes) & (F.col("fare_amount") > 0)
    )
