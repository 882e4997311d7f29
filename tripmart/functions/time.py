"""Date and time expressions on zone-less timestamps.

Every function here works on the wall-clock fields, so results do not depend on the
session time zone and survive daylight-saving switches.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _minute_number(moment: Column) -> Column:
    """Whole minutes since a moment before any trip."""
    since = moment - F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")
    return since.cast("interval minute").cast("bigint")


def minutes_between(start: Column, end: Column) -> Column:
    """Number of minute boundaries crossed from ``start`` to ``end`` (may be negative)."""
    return _minute_number(end) - _minute_number(start)


def minutes_sql(start: str, end: str) -> str:
    """``minutes_between`` as text, for the definitions of views."""

    def number(moment: str) -> str:
        return f"CAST(CAST({moment} - TIMESTAMP_NTZ'0001-01-01 00:00:00' AS INTERVAL MINUTE) AS BIGINT)"

    return f"{number(end)} - {number(start)}"


def day_of(moment: Column) -> Column:
    return moment.cast("date")


def midnight(day: dt.date) -> Column:
    """Literal start of a day, from text: a Python datetime would pass the session zone."""
    return F.lit(f"{day} 00:00:00").cast("timestamp_ntz")


def instant_of(moment: Column) -> Column:
    """The wall clock as a zoned timestamp, read as UTC whatever the session zone is."""
    since = moment - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_seconds(since.cast("interval second").cast("decimal(18,6)"))


def day_of_instant(instant: Column) -> Column:
    """The UTC day of a zoned timestamp."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / F.lit(86400)).cast("int"))
