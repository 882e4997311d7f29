"""Connected components of a graph of links, by alternating large and small stars.

Each step is a grouping for the smallest neighbour and a join back; tables are written between
steps, so a step reads files however many executors are lost, and a node with very many links is
split by the skew handling of the join. Links and components never reach the driver, only their
number and a checksum do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.workspace import written


def _fingerprint(links: DataFrame) -> tuple:
    mark = F.xxhash64("u", "v")
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(mark), F.sum(F.shiftright(mark, 24))).first())


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``node, root`` for every node with a link; the root is the smallest node of its component.

    ``links`` has two columns of comparable ids; order and repetition don't matter.
    """
    a, b = links.columns
    pairs = links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    now = written(spark, pairs.distinct(), "links")
    before = _fingerprint(now)
    while before[0]:
        both = written(spark, now.union(now.select("v", "u")), "links-both")
        least = written(spark, both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "links-least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(spark, large, "links-large")
        least = written(spark, large.groupBy("u").agg(F.min("v").alias("m")), "links-least")
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(spark, small.union(least).distinct(), "links")
        after = _fingerprint(now)
        if after == before:
            break
        before = after
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(now.select(F.col("v"), F.col("v")).distinct())
