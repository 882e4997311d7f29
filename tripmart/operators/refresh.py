"""Tables that are rebuilt in full: a new version is written beside the old, then one step switches to it.

A table's folder holds its versions and a file that names the current one. A build that breaks off leaves the file as
it was, so readers never see half a table. The version before the current one stays, for those still reading
it; older ones, and what a broken build left, go with the next build. Names of versions begin with an
underscore, so that reading the folder as it is finds nothing instead of several versions.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tripmart import storage, workspace

_CURRENT = "_current"
_VERSION = "_v-"


def current_path(spark: SparkSession, path: str) -> str:
    """Folder of the current version; the table's own one if it was never built in versions."""
    version = storage.read_text(spark, f"{path}/{_CURRENT}")
    return f"{path}/{version}" if version else path


def read_current(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """The current version; None before the first build."""
    place = current_path(spark, path)
    if not storage.exists(spark, place):
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(place)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def refresh(spark: SparkSession, frame: DataFrame, path: str) -> DataFrame:
    """Build a table anew and return it; ``frame`` may read the version before."""
    before = storage.read_text(spark, f"{path}/{_CURRENT}")
    version = f"{_VERSION}{uuid.uuid4().hex}"
    frame.write.parquet(f"{path}/{version}")
    storage.put_text(spark, f"{path}/{_CURRENT}", version)
    for name in storage.children(spark, path):
        if name.startswith(_VERSION) and name not in (version, before):
            workspace.remove(spark, f"{path}/{name}")
    return spark.read.schema(frame.schema).parquet(f"{path}/{version}")
