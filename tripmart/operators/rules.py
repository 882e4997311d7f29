"""Validation rules, written once and shared by the filter, the reject report and checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart.config import DEFAULT_RULES, Rules


def trip_rules(rules: Rules = DEFAULT_RULES) -> dict[str, Column]:
    unmetered = F.col("trip_type") == "fhv"
    minutes = F.col("trip_duration_minutes")
    fare = F.col("fare_amount")
    miles = F.col("trip_distance")
    mph = F.col("avg_speed_mph")
    zone = F.col("pickup_zone_id")
    return {
        "duration": (minutes > 0) & (minutes < rules.max_minutes),
        "fare": unmetered | ((fare > 0) & (fare < rules.max_fare)),
        "distance": unmetered | ((miles >= 0) & (miles < rules.max_miles)),
        "speed": unmetered | F.coalesce(mph < rules.max_mph, F.lit(True)),
        "zone": zone.isNotNull() & ~zone.isin(*rules.unusable_zones),
    }
