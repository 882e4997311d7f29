"""Session settings, business thresholds and reference values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

SERVICES = ("yellow", "green", "fhv")
METERED = ("yellow", "green")

# The landing grid a full load is expected to cover.
EXPECTED_MONTHS = ("2024-01", "2024-02", "2024-03")

# Files that one micro-batch of a stream takes, so that a first run over a large landing isn't one batch.
FILES_PER_BATCH = 1000

# City boroughs.
CITY_BOROUGHS = ("Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island")

# Code labels of the source records.
PAYMENT_TYPES = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
RATE_CODES = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
}
VENDORS = {1: "Creative Mobile", 2: "VeriFone"}

# The pipeline needs nothing beyond these. AQE merges small shuffle partitions but never makes
# more than the initial number: size that with ``shuffle_settings``.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # HotSpot never compiles methods beyond 8000 bytes of bytecode; a fused stage that gets
    # larger runs faster as separate operators.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Off, building a plan does not collect a stack trace for every column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


@dataclass(frozen=True)
class Rules:
    """Validation thresholds. All upper bounds are exclusive."""

    max_minutes: int = 180
    max_fare: float = 1000.0
    max_miles: float = 200.0
    max_mph: float = 100.0
    unusable_zones: tuple[int, ...] = (264, 265)
    lookback_days: int = 3


DEFAULT_RULES = Rules()


def shuffle_settings(shuffle_bytes: int, partition_bytes: int = 1 << 30) -> dict[str, str]:
    """Settings for jobs whose largest shuffle moves about ``shuffle_bytes``.

    The largest shuffle is the numbering of trip ids, which moves every staged row once; the
    facts shuffle partial aggregates only. Partitions that turn out small are merged.
    """
    partitions = max(200, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
    }


def spark_session(
    app_name: str = "tripmart", master: str | None = None, **settings: str
) -> SparkSession:
    """Session with the pipeline's settings; ``settings`` use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
