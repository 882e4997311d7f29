"""Text forms that feed content hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType


def _extreme_text(value: Column) -> Column:
    plain = F.regexp_replace(value.cast("decimal(38,21)").cast("string"), r"(\.\d+?)0*$", "$1")
    exponent = value.cast("string")
    for pattern, replacement in (
        (r"(\.0)?E(\d)", "e+$2"),
        (r"(\.0)?E-(\d)$", "e-0$2"),
        (r"(\.0)?E-", "e-"),
        ("NaN", "nan"),
        ("Infinity", "inf"),
    ):
        exponent = F.regexp_replace(exponent, pattern, replacement)
    size = F.abs(value)
    return F.when((size >= 1e-4) & (size < 1e16), plain).otherwise(exponent)


def double_text(value: Column) -> Column:
    """Shortest decimal text: plain for 1e-4 <= |x| < 1e16, else ``1.5e+16`` or ``2e-05``.

    Spark's own text agrees for 1e-3 <= |x| < 1e7. The rare rest is formatted in a lambda,
    which keeps that code out of the generated method: inlined for several columns it
    would outgrow what the JVM compiles.
    """
    size = F.abs(value)
    usual = ((size >= 1e-3) & (size < 1e7)) | (size == 0.0)
    extreme = F.transform(F.array(value), _extreme_text)
    return F.when(usual, value.cast("string")).otherwise(F.get(extreme, F.lit(0)))


def text_of(value: Column, data_type: DataType) -> Column:
    return double_text(value) if isinstance(data_type, DoubleType) else value.cast("string")
