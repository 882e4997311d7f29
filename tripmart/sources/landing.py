"""Landed trip files: batch scan, streaming scan and what is (not) there yet.

Files of a service lie either next to each other as ``<service>_tripdata_<month>.parquet``
or below ``service=<service>_tripdata/month=<month>/``; one glob matches both.

Files may store numbers in any width. Their footers are read by tasks, the files are grouped by the
types they store, and each group is read by its own types and cast to the declared ones, so that
everything above, the text of trip keys included, sees the declared types whatever a file holds.
A stream does the same with the files of each micro-batch: what streams is the names of files.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType

from tripmart import workspace
from tripmart.config import EXPECTED_MONTHS, FILES_PER_BATCH, SERVICES
from tripmart.functions.time import day_of
from tripmart.schemas import RAW
from tripmart.sources.footers import LEAST, footers, least_values, stored_type

NO_AGE_LIMIT = "36500d"

# Groups that the rows of a service month are dealt in.
PARTS = 8


def service_glob(root: str, service: str) -> str:
    """Pattern for the files of one service, in either layout."""
    return f"{root}/{{{service}_tripdata_*.parquet,service={service}_tripdata}}"


def _is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def _numeric(declared: StructType) -> list[str]:
    return [f.name for f in declared.fields if isinstance(f.dataType, NumericType)]


def _cast_scan(spark: SparkSession, paths: list[str], declared: StructType, stored: dict[str, str]) -> DataFrame:
    """Files that store numbers as ``stored`` says, as a relation of the declared types."""
    read = StructType.fromDDL(
        ", ".join(f"`{f.name}` {stored.get(f.name) or f.dataType.simpleString()}" for f in declared.fields)
    )
    frame = spark.read.schema(read).option("recursiveFileLookup", "true").parquet(*paths)
    casts = {
        f.name: F.col(f.name).cast(f.dataType)
        for f, r in zip(declared.fields, read.fields, strict=True)
        if f.dataType != r.dataType
    }
    return frame.withColumns(casts) if casts else frame


def _merged_types(spark: SparkSession, paths: list[str], declared: StructType) -> dict[str, str]:
    """Stored numeric types as Spark itself finds them; the declared ones where files differ or can't be read."""
    reader = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true")
    try:
        found = {f.name.lower(): f.dataType for f in reader.parquet(*paths).schema.fields}
    except (PySparkException, Py4JJavaError):
        return {}
    kinds = {name: found.get(name.lower()) for name in _numeric(declared)}
    return {name: kind.simpleString() for name, kind in kinds.items() if isinstance(kind, NumericType)}


def _by_stored_types(profile: DataFrame, declared: StructType) -> DataFrame:
    """``path`` and ``stored``: the types of the declared numeric columns, null where the footer couldn't be read."""
    stored = F.array(*(stored_type(F.col("types"), name) for name in _numeric(declared)))
    return profile.select("path", F.when(F.col("error").isNull(), stored).alias("stored"))


def scan_files(
    spark: SparkSession, service: str, files: DataFrame, everything: str | None = None
) -> DataFrame | None:
    """The files of a listing (``path``) as one relation of the declared types; None without files.

    One job reads the footers. Paths come to the driver only to be read from, and not even then if all files of
    ``everything``, a pattern, store the same types. Footers that tasks can't open (a store that only Spark
    knows) are left to Spark's own merging of schemas.
    """
    declared = RAW[service]
    names = _numeric(declared)
    # Both questions below are asked of the written result, so that footers are read once.
    place = workspace.fresh_path(spark, "footers")
    _by_stored_types(footers(files, files.count()), declared).write.parquet(place)
    found = spark.read.schema("path string, stored array<string>").parquet(place)
    groups = [r["stored"] for r in found.select("stored").distinct().collect()]
    scans = []
    for stored in groups:
        if len(groups) == 1 and everything:
            paths = [everything]
        else:
            chosen = F.col("stored").eqNullSafe(F.lit(None) if stored is None else F.array(*map(F.lit, stored)))
            paths = [r["path"] for r in found.where(chosen).select("path").collect()]
        if stored is None:
            types = _merged_types(spark, paths, declared)
        else:
            kinds = dict(zip(names, stored, strict=True))
            types = {name: kind for name, kind in kinds.items() if kind and _is_number(kind)}
        scans.append(_cast_scan(spark, paths, declared, types))
    workspace.remove(spark, place)
    return reduce(DataFrame.unionByName, scans) if scans else None


def _is_number(kind: str) -> bool:
    return kind.startswith("decimal") or kind in ("tinyint", "smallint", "int", "bigint", "float", "double")


def _listing(spark: SparkSession, path: str) -> DataFrame:
    """Files with size and time; contents aren't read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.option("pathGlobFilter", "*.parquet").load(path).select("path", "length", "modificationTime")


def scan_service(spark: SparkSession, root: str, service: str) -> DataFrame | None:
    """All landed files of one service as one relation; None when nothing landed."""
    path = service_glob(root, service)
    try:
        files = _listing(spark, path)
    except AnalysisException as error:
        if _is_missing(error):
            return None
        raise
    return scan_files(spark, service, files, everything=path)


def stream_files(spark: SparkSession, root: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Stream of the names of landed files, of all services and types; contents aren't read.

    With a checkpoint every file comes once, however old it is, at most ``files_per_batch`` at a time.
    """
    return (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        # By default a file a week older than the newest one seen is passed over.
        .option("maxFileAge", NO_AGE_LIMIT)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(root)
        .select("path", "length", "modificationTime")
    )


def stream_service(
    spark: SparkSession, root: str, service: str, files_per_batch: int | None = None
) -> DataFrame:
    """Streaming scan of files of the declared types (``stream_files`` takes any); with a checkpoint every file is
    read exactly once, however old it is."""
    reader = spark.readStream.schema(RAW[service]).option("recursiveFileLookup", "true")
    # By default a file a week older than the newest one seen is passed over.
    reader = reader.option("maxFileAge", NO_AGE_LIMIT)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(service_glob(root, service))


def available_services(
    spark: SparkSession, root: str, services: Iterable[str] = SERVICES
) -> dict[str, DataFrame]:
    """Relations of the services that have landed; the others are left out."""
    scans = {service: scan_service(spark, root, service) for service in services}
    present = {service: frame for service, frame in scans.items() if frame is not None}
    if not present:
        raise FileNotFoundError(f"no trip files below {root}")
    return present


def landed_services(spark: SparkSession, root: str, services: Iterable[str] = SERVICES) -> list[str]:
    """Services with files, by the listing alone; an error if there is none."""
    found = {r[0] for r in landed_files(spark, root).select("service").distinct().collect()}
    present = [s for s in services if s in found]
    if not present:
        raise FileNotFoundError(f"no trip files below {root}")
    return present


def tag_services(relations: dict[str, DataFrame]) -> DataFrame:
    """One relation over several raw services, tagged by ``service``."""
    tagged = (frame.withColumn("service", F.lit(name)) for name, frame in relations.items())
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def source_counts(relations: dict[str, DataFrame]) -> DataFrame:
    """Rows per raw relation, in one pass."""
    tags = (
        frame.select(F.lit(name).alias("source_name")) for name, frame in relations.items()
    )
    return (
        reduce(DataFrame.unionByName, tags)
        .groupBy("source_name")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def source_report(spark: SparkSession, relations: dict[str, DataFrame]) -> DataFrame:
    """Rows per raw relation; one that can't be read has its error instead and ends no other's count."""
    rows = []
    for name, frame in sorted(relations.items()):
        try:
            rows.append((name, frame.count(), None))
        except Exception as error:  # whatever the storage or the file format raises
            rows.append((name, None, str(error).splitlines()[0]))
    return spark.createDataFrame(rows, "source_name string, row_count long, error string")


def file_service(path: Column) -> Column:
    found = F.regexp_extract(path, f"({'|'.join(SERVICES)})_tripdata", 1)
    return F.nullif(found, F.lit(""))


def file_month(path: Column) -> Column:
    found = F.regexp_extract(path, r"_tripdata[^0-9]+(\d{4}-\d{2})", 1)
    return F.nullif(found, F.lit(""))


def landed_files(spark: SparkSession, root: str) -> DataFrame:
    """One row per landed file. Only the listing is read, never the contents."""
    return _listing(spark, root).select(
        file_service(F.col("path")).alias("service"),
        file_month(F.col("path")).alias("month"),
        "path",
        F.col("length").alias("bytes"),
    )


def file_listing(spark: SparkSession, root: str) -> DataFrame:
    """Landed files of known services with size and time; a file that is written anew differs in these."""
    listing = _listing(spark, root).select(
        file_service(F.col("path")).alias("service"), "path", "length", "modificationTime"
    )
    return listing.where(F.col("service").isNotNull())


def earliest_pickup(spark: SparkSession, service: str, files: DataFrame) -> dt.date | None:
    """The first pickup day in listed files (``path``) of a service; None without any pickup.

    Taken from the statistics in the files' footers, by tasks; files without them are read for this column.
    """
    pickup = next(f for f in RAW[service].fields if "pickup_datetime" in f.name)
    place = workspace.fresh_path(spark, "first-pickups")
    least_values(files, pickup.name).write.parquet(place)
    found = spark.read.schema(LEAST).parquet(place)
    days = [found.agg(F.min(F.col("least"))).first()[0]]
    unknown = [r["path"] for r in found.where(~F.col("known")).select("path").collect()]
    if unknown:
        frame = spark.read.schema(StructType([pickup])).parquet(*unknown)
        days.append(frame.agg(F.min(day_of(F.col(pickup.name)))).first()[0])
    workspace.remove(spark, place)
    return min((d for d in days if d is not None), default=None)


def landing_gaps(
    spark: SparkSession,
    root: str,
    services: Iterable[str] = SERVICES,
    months: Iterable[str] = EXPECTED_MONTHS,
) -> DataFrame:
    """Service months that are expected but have no file."""
    expected = spark.range(1).select(
        F.explode(F.array(*map(F.lit, services))).alias("service"),
        F.array(*map(F.lit, months)).alias("months"),
    )
    expected = expected.select("service", F.explode("months").alias("month"))
    landed = landed_files(spark, root).select("service", "month").distinct()
    return expected.join(landed, ["service", "month"], "left_anti")


def landing_summary(spark: SparkSession, root: str) -> DataFrame:
    return landed_files(spark, root).agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")
    )


def dealt(rows: DataFrame, service: Column, month: Column, key: Sequence[Column]) -> DataFrame:
    """Rows of a service month in at most ``PARTS`` groups, each group in one task.

    The rebalance hint lets AQE cut large groups and join small ones. It can cut only between the tasks that wrote
    a group, of which a file of one row group has a single one; so that a service month stays in bounds there too,
    the key says which group a row belongs to.
    """
    part = F.pmod(F.xxhash64(*key), F.lit(PARTS))
    return rows.withColumn("_dealt", F.xxhash64(service, month, part)).hint("rebalance", "_dealt").drop("_dealt")


def land(tagged: DataFrame, root: str, month: Column, mode: str = "overwrite", as_dealt: bool = False) -> None:
    """Write a tagged raw relation in the landing layout.

    Rows are dealt by service month first, unless they come ``as_dealt``: raw records are wide, and where they
    are derived from narrower rows it is cheaper to deal those.
    """
    rows = tagged if as_dealt else dealt(tagged, F.col("service"), month, [F.col(c) for c in tagged.columns])
    (
        rows.withColumn("service", F.concat("service", F.lit("_tripdata")))
        .withColumn("month", month)
        .write.mode(mode)
        .partitionBy("service", "month")
        .parquet(root)
    )
