"""Corpus pipeline: stages over documents, each written as Parquet and read again by the next.

Quality rules drop documents, the n-gram join keeps one of each group of near copies (five-word
shingles, similarity 0.8), substring dedup cuts passages that a smaller id holds too and drops
documents that lose all their words, decontamination drops documents that hold benchmark passages, and
packing places what is left in token sequences. The first four return the columns of documents; where
a text was cut, ``n_chars`` counts the new one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import decontamination, ngram_join, packing, quality_rules, substring_dedup
from tripmart.llm.common import WORD_CLASS, prepare, table
from tripmart.workspace import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group."""
    prepare(spark)
    return ngram_join.one_of_each(docs, percent=80, size=5)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that a smaller id holds too."""
    prepare(spark)
    cut, mark = substring_dedup.without_repeats(docs)
    left = cut.where(~F.col(mark) | F.rlike("text", F.lit(WORD_CLASS)))
    size = F.when(F.col(mark), F.length("text").cast(dict(docs.dtypes)["n_chars"])).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", size).select(*docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated."""
    prepare(spark)
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    prepare(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark_passages),
    ("best-fit packing", packed),
]

#: Token ids are beyond SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
