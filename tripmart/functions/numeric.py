"""Numeric casts and trip measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded_int(value: Column) -> Column:
    """Cast to int, halves to the even neighbour."""
    return F.rint(value).cast("int")


def speed_mph(miles: Column, minutes: Column) -> Column:
    hours = minutes / F.lit(60.0)
    return F.when((miles > 0) & (minutes > 0), miles / hours)


def speed_sql(miles: str, minutes: str) -> str:
    """``speed_mph`` as text, for the definitions of views."""
    return f"CASE WHEN {miles} > 0 AND {minutes} > 0 THEN {miles} / ({minutes} / 60.0D) END"


def tip_percentage(tip: Column, fare: Column) -> Column:
    return F.when((fare > 0) & tip.isNotNull(), tip / fare * F.lit(100.0))


def tip_sql(tip: str, fare: str) -> str:
    """``tip_percentage`` as text, for the definitions of views."""
    return f"CASE WHEN {fare} > 0 AND {tip} IS NOT NULL THEN {tip} / {fare} * 100.0D END"
