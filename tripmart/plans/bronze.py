"""Bronze: one standard shape for all services, null gates and trip ids.

Each standard column names the raw columns it can come from. A service's own files have one
of them; a relation that holds all services, tagged by ``service``, has all of them with
only the owner's filled. So the same projection serves a single service and the tagged
relation, and the latter is scanned once instead of once per service.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from tripmart.config import SERVICES
from tripmart.functions.numeric import rounded_int
from tripmart.functions.time import midnight
from tripmart.operators.trip_key import content_key, with_trip_id
from tripmart.schemas import RAW

_PICKUP = ("tpep_pickup_datetime", "lpep_pickup_datetime", "pickup_datetime")
_DROPOFF = ("tpep_dropoff_datetime", "lpep_dropoff_datetime", "dropOff_datetime")

# Standard column -> raw columns it is taken from as it is.
_TAKEN = {
    "pickup_datetime": _PICKUP,
    "dropoff_datetime": _DROPOFF,
    "pickup_zone_id": ("PULocationID",),
    "dropoff_zone_id": ("DOLocationID",),
    "dispatching_base_num": ("dispatching_base_num",),
    "affiliated_base_num": ("Affiliated_base_number",),
    "store_and_fwd_flag": ("store_and_fwd_flag",),
}
_WHOLE = {
    "passenger_count": "passenger_count",
    "vendor_id": "VendorID",
    "rate_code_id": "RatecodeID",
    "payment_type": "payment_type",
    # The source's own trip_type; the tag of the same name must not replace it, so both are
    # built in one select.
    "green_trip_type": "trip_type",
}
_MEASURES = (
    "trip_distance",
    "fare_amount",
    "extra",
    "mta_tax",
    "improvement_surcharge",
    "tip_amount",
    "tolls_amount",
    "total_amount",
)

# The seven hashed fields. The last three are the fare, distance and passengers of metered
# trips and the bases and the shared-ride flag of for-hire trips.
_KEY_FIELDS = (
    _PICKUP,
    _DROPOFF,
    ("PULocationID",),
    ("DOLocationID",),
    ("fare_amount", "dispatching_base_num"),
    ("trip_distance", "Affiliated_base_number"),
    ("passenger_count", "SR_Flag"),
)


def _first(names: Iterable[str], schema: StructType) -> Column | None:
    present = [F.col(name) for name in names if name in schema.names]
    return F.coalesce(*present) if len(present) > 1 else (present[0] if present else None)


def _whole(name: str, schema: StructType) -> Column:
    """Integer form of a raw column; fractions, where the type allows any, are rounded."""
    column = F.col(name)
    fractional = isinstance(schema[name].dataType, DoubleType)
    return rounded_int(column) if fractional else column.cast("int")


def _standard(schema: StructType, service: Column) -> dict[str, Column]:
    columns = {"trip_type": service}
    for target, names in _TAKEN.items():
        taken = _first(names, schema)
        if taken is not None:
            columns[target] = taken
    for target, name in _WHOLE.items():
        if name in schema.names:
            columns[target] = _whole(name, schema)
    for name in _MEASURES:
        if name in schema.names:
            columns[name] = F.col(name).cast("double")
    if "SR_Flag" in schema.names:
        columns["is_shared_ride"] = F.coalesce(F.col("SR_Flag") == 1, F.lit(False))
    return columns


def _stage(
    raw: DataFrame, service: Column, ids: bool, since: dt.date | None, by_day: bool = False
) -> DataFrame:
    schema = raw.schema
    columns = _standard(schema, service)
    if since:
        raw = raw.where(columns["pickup_datetime"] >= midnight(since))
    if ids:
        # The hash takes the raw values; casts apply to the published columns only.
        present = [[n for n in names if n in schema.names] for names in _KEY_FIELDS]
        columns["base_hash"] = content_key(schema, present)
    # Metered trips need both times, for-hire trips only the pickup.
    complete = columns["pickup_datetime"].isNotNull() & (
        (service == "fhv") | columns["dropoff_datetime"].isNotNull()
    )
    staged = raw.where(complete).select(
        *(column.alias(name) for name, column in columns.items()),
        F.current_timestamp().alias("loaded_at"),
    )
    return with_trip_id(staged, by_day=by_day) if ids else staged


def stage(
    raw: DataFrame, service: str, ids: bool = True, since: dt.date | None = None, by_day: bool = False
) -> DataFrame:
    """Standardise the raw relation of one service.

    Without ``ids`` the plan has no shuffle: consumers that never look at ids, as the fact
    tables, read the cheaper form. ``since`` keeps pickups from that day on; set here, the
    bound reaches every scan of the files that numbering the copies takes. With ``by_day`` numbered
    trips come dealt by day, as a table of days is written.
    """
    return _stage(raw, F.lit(service), ids, since, by_day)


def stage_tagged(raw: DataFrame, ids: bool = True) -> DataFrame:
    """Standardise a relation of all services, tagged by ``service``, in one scan."""
    known = raw.where(F.col("service").isin(*SERVICES))
    return _stage(known, F.col("service"), ids, since=None)


def stage_zones(raw_zones: DataFrame) -> DataFrame:
    return raw_zones.select(
        _whole("LocationID", raw_zones.schema).alias("zone_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone_name"),
        F.col("service_zone").alias("service_zone"),
        F.current_timestamp().alias("loaded_at"),
    )


def raw_columns(frame: DataFrame, service: str) -> DataFrame:
    """The columns of one service out of a tagged relation."""
    return frame.where(F.col("service") == service).select(*RAW[service].names)
