"""Hand-made raw records."""

from __future__ import annotations

import datetime as dt

from tripmart.schemas import RAW, RAW_ZONES

NOON = dt.datetime(2024, 1, 10, 12, 0, 0)

_METERED = {
    "VendorID": 1,
    "passenger_count": 1.0,
    "trip_distance": 2.0,
    "PULocationID": 1,
    "DOLocationID": 2,
    "RatecodeID": 1.0,
    "store_and_fwd_flag": "N",
    "payment_type": 1,
    "fare_amount": 10.0,
    "extra": 0.0,
    "mta_tax": 0.5,
    "improvement_surcharge": 0.3,
    "tip_amount": 1.0,
    "tolls_amount": 0.0,
    "total_amount": 11.8,
}


def _frame(spark, schema, records):
    return spark.createDataFrame([tuple(r[n] for n in schema.names) for r in records], schema)


def _metered(spark, service, prefix, records):
    times = {
        f"{prefix}_pickup_datetime": NOON,
        f"{prefix}_dropoff_datetime": NOON + dt.timedelta(minutes=10),
        "trip_type": 1.0,
    }
    renamed = (
        {
            {"pickup": f"{prefix}_pickup_datetime", "dropoff": f"{prefix}_dropoff_datetime"}.get(
                k, k
            ): v
            for k, v in record.items()
        }
        for record in records
    )
    return _frame(spark, RAW[service], [{**_METERED, **times, **r} for r in renamed])


def yellow(spark, *records):
    return _metered(spark, "yellow", "tpep", records)


def green(spark, *records):
    return _metered(spark, "green", "lpep", records)


def fhv(spark, *records):
    base = {
        "dispatching_base_num": "B1",
        "pickup_datetime": NOON,
        "dropOff_datetime": NOON + dt.timedelta(minutes=10),
        "PULocationID": 1,
        "DOLocationID": 2,
        "SR_Flag": None,
        "Affiliated_base_number": "B2",
    }
    names = {"pickup": "pickup_datetime", "dropoff": "dropOff_datetime"}
    return _frame(
        spark,
        RAW["fhv"],
        [{**base, **{names.get(k, k): v for k, v in r.items()}} for r in records],
    )


def raw_zones(spark, *extra):
    base = [
        (1, "Manhattan", "Alpha", "Yellow Zone"),
        (2, "Queens", "Beta Airport", "Boro Zone"),
        (3, "EWR", "Newark", "EWR"),
        (4, "Queens", "Gamma", "Airports"),
        (264, "Unknown", "N/A", "N/A"),
        (265, "N/A", "Outside of NYC", "N/A"),
    ]
    return spark.createDataFrame([*base, *extra], RAW_ZONES)
