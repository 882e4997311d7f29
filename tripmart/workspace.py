"""Shared folder for tables a job has to write before it can go on, and jobs that run side by side."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_LOCAL_ROOTS: dict[str, str] = {}
_SHIPPED: set[str] = set()


def ship_modules(spark: SparkSession) -> None:
    """Send this package's modules to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="modules-")) / f"{package.name}.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for module in sorted(package.rglob("*.py")):
            archive.write(module, module.relative_to(package.parent))
    context.addPyFile(str(path))
    _SHIPPED.add(context.applicationId)


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a machine-local folder; anywhere else a table
    written there would be invisible to the other executors.
    """
    root = spark.conf.get(_SETTING, None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder every executor can reach")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="tripmart-")
    return _LOCAL_ROOTS[context.applicationId]


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/tripmart/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared root that no table reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def written(spark: SparkSession, frame: DataFrame, label: str) -> DataFrame:
    """Write a result that several steps read, and return the written table.

    Unlike a cache it survives the loss of executors.
    """
    path = fresh_path(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def together(spark: SparkSession, *steps: Callable[[], DataFrame]) -> list[DataFrame]:
    """Results of steps that run Spark jobs and don't need each other, run side by side."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]]
