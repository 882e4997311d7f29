"""The zone lookup: CSV scan and seed table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.operators.refresh import refresh
from tripmart.schemas import RAW_ZONES


def scan_zones(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV; ``N/A`` stays text, only empty fields become null."""
    return spark.read.schema(RAW_ZONES).option("header", "true").csv(path)


def seed_zones(spark: SparkSession, csv_path: str, table_path: str) -> DataFrame:
    """Load the versioned lookup into a table, which is replaced as a whole, and return the table."""
    return refresh(spark, scan_zones(spark, csv_path), table_path)
