"""Layer namespaces and catalog listing."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LAYERS = ("raw", "staging", "intermediate", "marts", "seeds")


def namespace(layer: str, prefix: str = "tripmart") -> str:
    return f"{prefix}_{layer}" if prefix else layer


def create_namespaces(spark: SparkSession, root: str, prefix: str = "tripmart") -> None:
    for layer in LAYERS:
        name = namespace(layer, prefix)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{root}/_catalog/{name}'")


def register_files(spark: SparkSession, database: str, paths: Mapping[str, str]) -> None:
    """Expose parquet files as views; reading a view reads the files as they are then."""
    for view, path in paths.items():
        spark.sql(
            f"CREATE OR REPLACE VIEW {database}.{view} AS SELECT * FROM parquet.`{path}`"
        )


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Relations of a layer with their row counts, sorted by name."""
    names = sorted(
        table.name for table in spark.catalog.listTables(database) if not table.isTemporary
    )
    counts = (
        spark.table(f"{database}.{name}").agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count")
        )
        for name in names
    )
    none = spark.createDataFrame([], "table_name string, row_count long")
    return reduce(DataFrame.unionByName, counts, none).orderBy("table_name")
