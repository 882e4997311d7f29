"""The checks the pipeline declares for its models."""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart import workspace
from tripmart.config import DEFAULT_RULES, METERED, SERVICES, Rules
from tripmart.operators.quality import (
    Check,
    accepted_range,
    accepted_values,
    lines_of,
    not_null,
    reference_check,
    run_checks,
    unique,
)
from tripmart.operators.rules import trip_rules
from tripmart.plans.silver import with_measures
from tripmart.schemas import DAILY_KEYS, ZONE_KEYS

_BRONZE = {service: f"stg_{service}_trips" for service in SERVICES}


def trip_checks(rules: Rules = DEFAULT_RULES) -> list[Check]:
    checks: list[Check] = []
    for service, model in _BRONZE.items():
        checks += [
            unique(model, "trip_id"),
            not_null(model, "trip_id"),
            accepted_values(model, "trip_type", service),
            not_null(model, "pickup_datetime"),
        ]
        if service in METERED:
            checks.append(not_null(model, "dropoff_datetime"))
    checks += [
        unique("int_trips_unioned", "trip_id"),
        not_null("int_trips_unioned", "trip_id"),
        not_null("int_trips_unioned", "trip_type"),
        accepted_values("int_trips_unioned", "trip_type", *SERVICES),
        not_null("int_trips_unioned", "pickup_datetime"),
        unique("int_trips_enriched", "trip_id"),
        not_null("int_trips_enriched", "trip_id"),
        not_null("int_trips_enriched", "trip_type"),
        unique("int_trips_validated", "trip_id"),
        not_null("int_trips_validated", "trip_id"),
        not_null("int_trips_validated", "trip_type"),
        accepted_range(
            "int_trips_validated", "trip_duration_minutes", 0, rules.max_minutes,
            inclusive=False,
        ),
    ]
    return checks


def documented_checks() -> list[Check]:
    """Metered fares are positive and distances not negative after validation."""
    metered = F.col("trip_type").isin(*METERED)
    model = "int_trips_validated"
    return [
        accepted_range(model, "fare_amount", low=0, inclusive=False, only_if=metered),
        accepted_range(model, "trip_distance", low=0, only_if=metered),
    ]


def row_checks(*models: str, rules: Rules = DEFAULT_RULES) -> list[Check]:
    """The checks of some models of trips that one row can break."""
    checks = trip_checks(rules) + documented_checks()
    return [c for c in checks if c.model in models and c.kind != "unique"]


def zone_checks() -> list[Check]:
    checks = []
    for model in ("stg_taxi_zones", "dim_zones"):
        checks += [
            unique(model, "zone_id"),
            not_null(model, "zone_id"),
            not_null(model, "borough"),
            not_null(model, "zone_name"),
        ]
    return checks


def daily_checks() -> list[Check]:
    model = "fct_daily_trips"
    return [
        not_null(model, "trip_date"),
        not_null(model, "pickup_borough"),
        not_null(model, "trip_type"),
        accepted_values(model, "trip_type", *SERVICES),
        not_null(model, "total_trips"),
        accepted_range(model, "total_trips", low=0),
        unique(model, *DAILY_KEYS),
    ]


def zone_fact_checks() -> list[Check]:
    model = "fct_zone_metrics"
    return [*(not_null(model, key) for key in ZONE_KEYS), unique(model, *ZONE_KEYS)]


def trip_stream(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Unioned trips with how often each occurs after the zone lookups.

    A lookup can only repeat a trip, by a zone id that occurs more than once, so the
    multiplicity stands in for the enriched rows.
    """
    times = zones.groupBy("zone_id").agg(F.count(F.lit(1)).alias("times"))
    for role in ("pickup", "dropoff"):
        trips = trips.join(
            times.withColumnsRenamed({"zone_id": f"{role}_zone_id", "times": f"{role}_times"}),
            f"{role}_zone_id",
            "left",
        )
    occurs = F.coalesce("pickup_times", F.lit(1)) * F.coalesce("dropoff_times", F.lit(1))
    return with_measures(trips.withColumn("occurs", occurs))


def trip_weights(rules: Rules = DEFAULT_RULES) -> dict[str, Column]:
    """How often a row of ``trip_stream`` occurs in each model."""
    once, never = F.lit(1), F.lit(0)
    valid = reduce(lambda a, b: a & b, trip_rules(rules).values())
    weights = {
        model: F.when(F.col("trip_type") == service, once).otherwise(never)
        for service, model in _BRONZE.items()
    }
    weights["int_trips_unioned"] = once
    weights["int_trips_enriched"] = F.col("occurs")
    weights["int_trips_validated"] = F.when(valid, F.col("occurs")).otherwise(never)
    return weights


def zone_weights(rules: Rules = DEFAULT_RULES) -> dict[str, Column]:
    kept = ~F.col("zone_id").isin(*rules.unusable_zones)
    return {
        "stg_taxi_zones": F.lit(1),
        "dim_zones": F.when(kept, F.lit(1)).otherwise(F.lit(0)),
    }


#: Checks, by model, column and kind, that are known to hold and aren't run again.
Proven = Collection[tuple[str, str, str]]


def _chosen(checks: list[Check], kinds: tuple[str, ...] | None) -> list[Check]:
    return [c for c in checks if kinds is None or c.kind in kinds]


def trip_report(
    trips: DataFrame,
    zones: DataFrame,
    kinds: tuple[str, ...] | None = None,
    rules: Rules = DEFAULT_RULES,
    without_ids: DataFrame | None = None,
    validated: DataFrame | None = None,
    proven: Proven = (),
) -> list[DataFrame]:
    """Checks of the trips' models; one scan of ``trips`` and one of ``validated``, if given.

    Where ids are not stored but computed, ``without_ids`` gives the same trips for reports that do not
    look at them.
    """
    checks = _chosen(trip_checks(rules) + documented_checks(), kinds)
    parts = []
    held = [c for c in checks if c.name in proven]
    if held:
        parts.append(lambda: lines_of(zones.sparkSession, dict.fromkeys(held, 0)))
    checks = [c for c in checks if c.name not in proven]
    stored = [c for c in checks if validated is not None and c.model == "int_trips_validated"]
    on_trips = [c for c in checks if all(c is not s for s in stored)]
    if on_trips:
        use_ids = without_ids is None or any(c.columns == ("trip_id",) for c in on_trips)
        stream = trip_stream(trips if use_ids else without_ids, zones)
        parts.append(lambda: run_checks(stream, on_trips, trip_weights(rules)))
    if stored:
        parts.append(lambda: run_checks(validated, stored))
    return workspace.together(zones.sparkSession, *parts) if parts else []


def table_report(
    zones: DataFrame,
    dimension: DataFrame,
    daily: DataFrame,
    zone_fact: DataFrame,
    kinds: tuple[str, ...] | None = None,
    rules: Rules = DEFAULT_RULES,
    proven: Proven = (),
) -> list[DataFrame]:
    """Checks of the lookup, the dimension and the facts."""
    parts = []
    for frame, checks, weights in (
        (zones, zone_checks(), zone_weights(rules)),
        (daily, daily_checks(), None),
        (zone_fact, zone_fact_checks(), None),
    ):
        checks = _chosen(checks, kinds)
        held = [c for c in checks if c.name in proven]
        checks = [c for c in checks if c.name not in proven]
        if held:
            parts.append(lines_of(zones.sparkSession, dict.fromkeys(held, 0)))
        if checks:
            parts.append(run_checks(frame, checks, weights))
    if kinds is None or "relationships" in kinds:
        parts.append(reference_check(zone_fact, dimension, "zone_id", "fct_zone_metrics"))
    return parts


def quality_report(
    trips: DataFrame,
    zones: DataFrame,
    dimension: DataFrame,
    daily: DataFrame,
    zone_fact: DataFrame,
    kinds: tuple[str, ...] | None = None,
    rules: Rules = DEFAULT_RULES,
    without_ids: DataFrame | None = None,
    validated: DataFrame | None = None,
    proven: Proven = (),
) -> DataFrame:
    """Every check with its number of failures; ``kinds`` restricts the kinds of checks.

    ``trips`` are the unioned trips with ids, ``zones`` the staged lookup. ``validated`` are the stored
    validated trips; their checks then read these rows. Without it the model is derived from
    ``trips``, as the other models that aren't stored are.
    """
    parts = trip_report(trips, zones, kinds, rules, without_ids, validated, proven)
    parts += table_report(zones, dimension, daily, zone_fact, kinds, rules, proven)
    return reduce(DataFrame.unionByName, parts)
