"""Declared schemas of the raw sources and contracts of the layers above them."""

from __future__ import annotations

from pyspark.sql import types as T
from pyspark.sql.types import StringType, StructField, StructType

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _schema(columns: str) -> StructType:
    """Schema from ``name type, name type, ...`` without needing a session."""
    pairs = (column.split() for column in columns.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


_METERED_TAIL = """
    passenger_count double, trip_distance double, PULocationID int, DOLocationID int,
    RatecodeID double, store_and_fwd_flag string, payment_type int, fare_amount double,
    extra double, mta_tax double, improvement_surcharge double, tip_amount double,
    tolls_amount double, total_amount double
"""

RAW = {
    "yellow": _schema(
        "VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz,"
        + _METERED_TAIL
    ),
    "green": _schema(
        "VendorID int, lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz,"
        + _METERED_TAIL
        + ", trip_type double"
    ),
    "fhv": _schema(
        "dispatching_base_num string, pickup_datetime timestamp_ntz,"
        " dropOff_datetime timestamp_ntz, PULocationID int, DOLocationID int, SR_Flag int,"
        " Affiliated_base_number string"
    ),
}

RAW_ZONES = _schema("LocationID int, Borough string, Zone string, service_zone string")

_METERED_BRONZE = """
    trip_id string, trip_type string, pickup_datetime timestamp_ntz,
    dropoff_datetime timestamp_ntz, pickup_zone_id int, dropoff_zone_id int,
    passenger_count int, trip_distance double, fare_amount double, extra double,
    mta_tax double, improvement_surcharge double, tip_amount double, tolls_amount double,
    total_amount double, vendor_id int, rate_code_id int, store_and_fwd_flag string,
    payment_type int
"""

_UNIONED = """
    trip_id string, trip_type string, pickup_datetime timestamp_ntz,
    dropoff_datetime timestamp_ntz, pickup_zone_id int, dropoff_zone_id int,
    passenger_count int, trip_distance double, fare_amount double, extra double,
    mta_tax double, improvement_surcharge double, tip_amount double, tolls_amount double,
    total_amount double, vendor_id int, rate_code_id int, payment_type int,
    loaded_at timestamp
"""

_ENRICHED = (
    _UNIONED
    + """,
    pickup_zone_name string, pickup_borough string, pickup_service_zone string,
    dropoff_zone_name string, dropoff_borough string, dropoff_service_zone string,
    trip_duration_minutes bigint, avg_speed_mph double, tip_percentage double
"""
)

CONTRACTS = {
    "stg_yellow_trips": _schema(_METERED_BRONZE + ", loaded_at timestamp"),
    "stg_green_trips": _schema(
        _METERED_BRONZE + ", green_trip_type int, loaded_at timestamp"
    ),
    "stg_fhv_trips": _schema(
        "trip_id string, trip_type string, pickup_datetime timestamp_ntz,"
        " dropoff_datetime timestamp_ntz, pickup_zone_id int, dropoff_zone_id int,"
        " dispatching_base_num string, affiliated_base_num string, is_shared_ride boolean,"
        " loaded_at timestamp"
    ),
    "stg_taxi_zones": _schema(
        "zone_id int, borough string, zone_name string, service_zone string,"
        " loaded_at timestamp"
    ),
    "int_trips_unioned": _schema(_UNIONED),
    "int_trips_enriched": _schema(_ENRICHED),
    "int_trips_validated": _schema(_ENRICHED),
    "dim_zones": _schema(
        "zone_id int, borough string, zone_name string, service_zone string,"
        " is_airport boolean, is_yellow_zone boolean, is_nyc_borough boolean,"
        " loaded_at timestamp"
    ),
    "fct_daily_trips": _schema(
        "trip_date date, pickup_borough string, trip_type string, total_trips bigint,"
        " total_passengers bigint, total_distance_miles double, avg_distance_miles double,"
        " total_fare double, avg_fare double, total_tips double, avg_tip_percentage double,"
        " avg_duration_minutes double, updated_at timestamp"
    ),
    "fct_zone_metrics": _schema(
        "zone_id int, metric_date date, trip_type string, pickups bigint, dropoffs bigint,"
        " total_fare_from_zone double, avg_fare_from_zone double,"
        " avg_distance_from_zone double, avg_duration_from_zone double, updated_at timestamp"
    ),
}

DAILY_KEYS = ["trip_date", "pickup_borough", "trip_type"]
ZONE_KEYS = ["zone_id", "metric_date", "trip_type"]

COMMON_TRIP_COLUMNS = CONTRACTS["int_trips_unioned"].names


def tagged_raw_schema() -> StructType:
    """Superset of the raw services plus the ``service`` tag."""
    fields: dict[str, StructField] = {}
    for schema in RAW.values():
        for field in schema.fields:
            fields.setdefault(field.name, field)
    service = StructField("service", StringType())
    return StructType([service, *fields.values()])
