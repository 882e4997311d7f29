"""Gold: zone dimension, the two daily facts and the reports on them."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.config import (
    CITY_BOROUGHS,
    DEFAULT_RULES,
    PAYMENT_TYPES,
    RATE_CODES,
    VENDORS,
    Rules,
)
from tripmart.functions.sums import exact_totals, mean_of, sum_of
from tripmart.functions.time import day_of
from tripmart.schemas import DAILY_KEYS, ZONE_KEYS


def _yes(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def dim_zones(zones: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    kind = F.col("service_zone")
    return zones.where(~F.col("zone_id").isin(*rules.unusable_zones)).select(
        "zone_id",
        "borough",
        "zone_name",
        "service_zone",
        _yes((kind == "Airports") | F.col("zone_name").contains("Airport")).alias("is_airport"),
        _yes(kind == "Yellow Zone").alias("is_yellow_zone"),
        _yes(F.col("borough").isin(*CITY_BOROUGHS)).alias("is_nyc_borough"),
        "loaded_at",
    )


def _total(totals: str) -> Column:
    """Sum with nulls as zero, so a group without values sums to 0."""
    return F.coalesce(sum_of(totals), F.lit(0.0))


def daily_trips(validated: DataFrame) -> DataFrame:
    """Trips, passengers, distance, fares, tips and duration per day, borough and service."""
    totals = (
        validated.where(F.col("pickup_borough").isNotNull())
        .withColumn("trip_date", day_of(F.col("pickup_datetime")))
        .groupBy(*DAILY_KEYS)
        .agg(
            F.count(F.lit(1)).alias("total_trips"),
            F.sum(F.coalesce("passenger_count", F.lit(0))).alias("total_passengers"),
            exact_totals("trip_distance").alias("_miles"),
            exact_totals("fare_amount").alias("_fare"),
            exact_totals("tip_amount").alias("_tips"),
            exact_totals("tip_percentage").alias("_share"),
            F.avg("trip_duration_minutes").alias("avg_duration_minutes"),
        )
    )
    return totals.select(
        *DAILY_KEYS,
        "total_trips",
        "total_passengers",
        _total("_miles").alias("total_distance_miles"),
        mean_of("_miles").alias("avg_distance_miles"),
        _total("_fare").alias("total_fare"),
        mean_of("_fare").alias("avg_fare"),
        _total("_tips").alias("total_tips"),
        mean_of("_share").alias("avg_tip_percentage"),
        "avg_duration_minutes",
        F.current_timestamp().alias("updated_at"),
    )


def pickup_metrics(validated: DataFrame) -> DataFrame:
    totals = (
        validated.where(F.col("pickup_zone_id").isNotNull())
        .groupBy(
            F.col("pickup_zone_id").alias("zone_id"),
            day_of(F.col("pickup_datetime")).alias("metric_date"),
            "trip_type",
        )
        .agg(
            F.count(F.lit(1)).alias("pickups"),
            exact_totals("fare_amount").alias("_fare"),
            exact_totals("trip_distance").alias("_miles"),
            F.avg("trip_duration_minutes").alias("avg_duration_from_zone"),
        )
    )
    return totals.select(
        *ZONE_KEYS,
        "pickups",
        _total("_fare").alias("total_fare_from_zone"),
        mean_of("_fare").alias("avg_fare_from_zone"),
        mean_of("_miles").alias("avg_distance_from_zone"),
        "avg_duration_from_zone",
    )


def dropoff_metrics(validated: DataFrame) -> DataFrame:
    """Arrivals per zone, counted on the day of the pickup."""
    return (
        validated.where(F.col("dropoff_zone_id").isNotNull())
        .groupBy(
            F.col("dropoff_zone_id").alias("zone_id"),
            day_of(F.col("pickup_datetime")).alias("metric_date"),
            "trip_type",
        )
        .agg(F.count(F.lit(1)).alias("dropoffs"))
    )


def zone_metrics_joined(validated: DataFrame) -> DataFrame:
    """Zone fact as a full outer join of both aggregates; reads the trips twice."""
    joined = pickup_metrics(validated).join(dropoff_metrics(validated), ZONE_KEYS, "full")
    return joined.select(
        *ZONE_KEYS,
        F.coalesce("pickups", F.lit(0)).alias("pickups"),
        F.coalesce("dropoffs", F.lit(0)).alias("dropoffs"),
        "total_fare_from_zone",
        "avg_fare_from_zone",
        "avg_distance_from_zone",
        "avg_duration_from_zone",
        F.current_timestamp().alias("updated_at"),
    )


def zone_metrics(validated: DataFrame) -> DataFrame:
    """Zone fact in one pass: every trip counts for its pickup and its dropoff zone.

    One scan and one shuffle of partial aggregates. Measures belong to the pickup side, so
    a zone that only receives trips has null measures and zero pickups.
    """
    sides = F.array(
        F.struct(F.col("pickup_zone_id").alias("zone_id"), F.lit(True).alias("starts")),
        F.struct(F.col("dropoff_zone_id").alias("zone_id"), F.lit(False).alias("starts")),
    )
    visits = validated.select(
        day_of(F.col("pickup_datetime")).alias("metric_date"),
        "trip_type",
        "fare_amount",
        "trip_distance",
        "trip_duration_minutes",
        F.inline(sides),
    ).where(F.col("zone_id").isNotNull())

    def started(column: str) -> Column:
        return F.when(F.col("starts"), F.col(column)).alias(f"_{column}")

    totals = (
        visits.select(*ZONE_KEYS, "starts", *map(started, ("fare_amount", "trip_distance", "trip_duration_minutes")))
        .groupBy(*ZONE_KEYS)
        .agg(
            F.count_if("starts").alias("pickups"),
            F.count_if(~F.col("starts")).alias("dropoffs"),
            exact_totals("_fare_amount").alias("_fare"),
            exact_totals("_trip_distance").alias("_miles"),
            F.avg("_trip_duration_minutes").alias("avg_duration_from_zone"),
        )
    )
    return totals.select(
        *ZONE_KEYS,
        "pickups",
        "dropoffs",
        F.when(F.col("pickups") > 0, _total("_fare")).alias("total_fare_from_zone"),
        mean_of("_fare").alias("avg_fare_from_zone"),
        mean_of("_miles").alias("avg_distance_from_zone"),
        "avg_duration_from_zone",
        F.current_timestamp().alias("updated_at"),
    )


def daily_summary(daily: DataFrame, since: dt.date) -> DataFrame:
    return (
        daily.where(F.col("trip_date") >= F.lit(since))
        .select(
            "trip_date",
            "pickup_borough",
            "trip_type",
            "total_trips",
            "avg_fare",
            "avg_duration_minutes",
        )
        .orderBy("trip_date", F.desc("total_trips"))
    )


def busiest_zones(metrics: DataFrame, dimension: DataFrame, top: int = 10) -> DataFrame:
    """Report of the zone names with most pickups; ids that share a name are merged."""
    return (
        metrics.join(dimension.select("zone_id", "zone_name", "borough"), "zone_id")
        .groupBy("zone_name", "borough")
        .agg(
            F.sum("pickups").alias("total_pickups"),
            F.sum("dropoffs").alias("total_dropoffs"),
        )
        .orderBy(F.desc("total_pickups"), "zone_name", "borough")
        .limit(top)
    )


def daily_trips_simple(enriched: DataFrame) -> DataFrame:
    """The simpler design variant: per day and borough, tips as a fraction of the fare."""
    share = F.col("tip_amount") / F.nullif(F.col("fare_amount"), F.lit(0.0))
    keys = ["trip_date", "pickup_borough"]
    totals = (
        enriched.withColumns({"trip_date": day_of(F.col("pickup_datetime")), "_tip_share": share})
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("total_trips"),
            F.sum("passenger_count").alias("total_passengers"),
            exact_totals("trip_distance").alias("_miles"),
            exact_totals("fare_amount").alias("_fare"),
            exact_totals("tip_amount").alias("_tips"),
            exact_totals("_tip_share").alias("_share"),
            F.avg("trip_duration_minutes").alias("avg_duration_minutes"),
        )
    )
    return totals.select(
        *keys,
        "total_trips",
        "total_passengers",
        sum_of("_miles").alias("total_distance_miles"),
        mean_of("_miles").alias("avg_distance_miles"),
        sum_of("_fare").alias("total_fares"),
        mean_of("_fare").alias("avg_fare"),
        sum_of("_tips").alias("total_tips"),
        mean_of("_share").alias("avg_tip_percentage"),
        "avg_duration_minutes",
    )


def decode_codes(trips: DataFrame) -> DataFrame:
    """Add the labels of payment, rate and vendor codes; unknown codes stay null.

    The code lists are constants of a few entries, so they become one literal map each and
    need no join.
    """
    labels = {
        "payment_type": ("payment_label", PAYMENT_TYPES),
        "rate_code_id": ("rate_label", RATE_CODES),
        "vendor_id": ("vendor_label", VENDORS),
    }
    return trips.withColumns(
        {
            target: F.try_element_at(_literal_map(codes), F.col(source))
            for source, (target, codes) in labels.items()
        }
    )


def _literal_map(codes: dict[int, str]) -> Column:
    return F.create_map(
        *reduce(lambda out, item: [*out, F.lit(item[0]), F.lit(item[1])], codes.items(), [])
    )
