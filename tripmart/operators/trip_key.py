"""Deterministic trip ids: content hash plus the number of the copy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmart.functions.text import text_of
from tripmart.functions.time import day_of

# A pickup second with more trips than this is spread over several tasks. The list of such seconds is
# broadcast; it has at most one entry for so many trips, 16 MB for a million million of them.
CROWDED_SECOND = 1_000_000

# Tasks over which the trips of a day are dealt at most where they are numbered day by day.
PARTS_OF_DAY = 8

# Order of the copies of one key: the fields that are not part of it, and the two that the
# key cannot tell from empty text when null. Only identical, interchangeable rows tie.
TIE_BREAKERS = (
    "extra",
    "mta_tax",
    "improvement_surcharge",
    "tip_amount",
    "tolls_amount",
    "total_amount",
    "vendor_id",
    "rate_code_id",
    "store_and_fwd_flag",
    "payment_type",
    "green_trip_type",
    "dispatching_base_num",
    "affiliated_base_num",
)


def content_key(schema: StructType, fields: Sequence[Sequence[str]]) -> Column:
    """MD5 over the text of the raw fields, ``|`` between them, null as empty text.

    A field lists the raw columns it may come from; the first that is not null counts.
    """
    texts = (
        F.coalesce(*(text_of(F.col(n), schema[n].dataType) for n in names), F.lit(""))
        for names in fields
    )
    return F.md5(F.concat_ws("|", *texts))


def with_trip_id(
    frame: DataFrame, key: str = "base_hash", crowded: int = CROWDED_SECOND, by_day: bool = False
) -> DataFrame:
    """Replace ``key`` by ``trip_id`` = key + ``_`` + running number among its copies.

    The pickup time is part of the key, so counting trips per pickup second (one narrow
    column, combined before the shuffle) bounds the size of every key group. Groups within
    the bound are numbered by a plain window. The rest are collapsed to rows that differ in the
    order of copies, with a copy count, cut into consecutive slices of that order, numbered per
    slice and expanded again, so that no task ever holds a whole crowded group. Both branches
    number in the same order, so an id doesn't depend on the branch its trip takes. When no
    second is crowded, AQE finds the broadcast empty and drops the second branch before it runs.

    With ``by_day`` trips are dealt by parts of their days, which keeps copies together just as well, so that
    a table of days can be written from the same tasks without shuffling all rows again.
    """
    # The time comes first, because a sort compares its first column fastest.
    group = ["pickup_datetime", key, "trip_type"]
    busy = (
        frame.groupBy("pickup_datetime")
        .agg(F.count(F.lit(1)).alias("_trips"))
        .where(F.col("_trips") > crowded)
        .select("pickup_datetime")
    )
    busy = F.broadcast(busy)

    ties = [c for c in TIE_BREAKERS if c in frame.columns]
    order = [F.asc_nulls_first(c) for c in ties]
    plain = frame.join(busy, "pickup_datetime", "left_anti")
    dealt = []
    if by_day:
        dealt = ["_day", "_part"]
        pickup = F.col("pickup_datetime")
        part = F.pmod(F.xxhash64(pickup), F.lit(PARTS_OF_DAY)).cast("int")
        plain = plain.withColumns({"_day": day_of(pickup), "_part": part}).repartition(*dealt)
    copy = F.row_number().over(Window.partitionBy(*dealt, *group).orderBy(*order))
    plain = plain.withColumn("_copy", copy).drop(*dealt)
    spread = _number_crowded(frame.join(busy, "pickup_datetime"), group, ties, crowded)
    numbered = plain.unionByName(spread)

    trip_id = F.concat(F.col(key), F.lit("_"), F.col("_copy").cast("string"))
    rest = [c for c in frame.columns if c != key]
    return numbered.select(trip_id.alias("trip_id"), *rest)


def _number_crowded(
    rows: DataFrame, group: list[str], ties: list[str], chunk: int
) -> DataFrame:
    columns = rows.columns
    order = [F.asc_nulls_first(c) for c in ties]
    distinct = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    # Some of the tie-breakers' values, chosen by their hash, cut the order of a group: about one for
    # each chunk of different values. Equal values stay on the same side of every cut.
    place = F.struct(*ties)
    cuts = (
        distinct.where(F.pmod(F.xxhash64(*ties, F.lit(1)), F.lit(chunk)) == 0)
        .groupBy(*group)
        .agg(F.sort_array(F.collect_set(place)).alias("_cuts"))
    )
    distinct = distinct.join(cuts, group, "left").withColumn(
        "_slice", F.coalesce(F.size(F.filter("_cuts", lambda c: c < place)), F.lit(0))
    )
    distinct = distinct.drop("_cuts")
    sizes = distinct.groupBy(*group, "_slice").agg(F.sum("_copies").alias("_size"))
    before_slice = (
        Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = sizes.select(
        *group,
        "_slice",
        F.coalesce(F.sum("_size").over(before_slice), F.lit(0)).alias("_start"),
    )
    before_row = (
        Window.partitionBy(*group, "_slice")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = distinct.join(starts, [*group, "_slice"]).withColumn(
        "_first",
        F.col("_start") + F.coalesce(F.sum("_copies").over(before_row), F.lit(0)),
    )
    # Copies are written out in two steps: chunk heads, spread over tasks, then their rows.
    last = F.col("_copies") - 1
    heads = placed.withColumn(
        "_head", F.explode(F.sequence(F.lit(0).cast("bigint"), last, F.lit(chunk).cast("bigint")))
    ).repartition(*group, "_first", "_head")
    within = F.sequence(F.col("_head"), F.least(F.col("_head") + F.lit(chunk - 1), last))
    return heads.withColumn("_at", F.explode(within)).select(
        *columns, (F.col("_first") + F.col("_at") + 1).alias("_copy")
    )


def with_surrogate_id(frame: DataFrame) -> DataFrame:
    """Unique row ids without a global sort; they are neither dense nor reproducible."""
    return frame.select(F.monotonically_increasing_id().alias("row_id"), "*")
