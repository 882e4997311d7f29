"""Registered queries of this subpackage and their SQL counterparts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripmart.llm import (
    binary_records,
    bpe,
    chat_tree,
    decontamination,
    fill_middle,
    license_scan,
    ngram_join,
    packing,
    quality_classifier,
    quality_rules,
    substring_dedup,
    toxicity,
    vector_codes,
)
from tripmart.llm.common import prepare, table


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in all documents."""
    prepare(spark)
    return license_scan.op6_license_scan(table(spark, sf_dir, "documents"))


def op6_license_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in all documents, however they are wrapped."""
    prepare(spark)
    return license_scan.op6_license_windows(table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents by a quadratic discriminant."""
    prepare(spark)
    return quality_classifier.op7_quality_classifier(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op8_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as token trees, read back."""
    prepare(spark)
    return chat_tree.op8_chat_tree(table(spark, sf_dir, "conversations"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose shingles agree, over all documents."""
    prepare(spark)
    return ngram_join.op9_ngram_join(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-first quality rules over all documents."""
    return quality_rules.op10_quality_rules(table(spark, sf_dir, "documents"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of the restored text of all documents."""
    prepare(spark)
    return toxicity.op1_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 13 words or more that smaller ids hold too, removed from all documents."""
    prepare(spark)
    return substring_dedup.op2_substring_dedup(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verbatim passages of the benchmark in all documents."""
    prepare(spark)
    return decontamination.op3_decontamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as records of token ids, read back from the files."""
    prepare(spark)
    return binary_records.op4_binary_records(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into token sequences."""
    prepare(spark)
    return packing.op5_best_fit_packing(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors by codebooks of their parts."""
    prepare(spark)
    return vector_codes.op11_vector_codes(table(spark, sf_dir, "embeddings"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents turned for filling in the middle, and restored."""
    prepare(spark)
    return fill_middle.op12_fill_in_middle(table(spark, sf_dir, "documents"))


def op13_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by a streaming byte-level BPE, and decoded."""
    prepare(spark)
    return bpe.op13_bpe_codec(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_binary_records": op4_binary_records,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_license_scan": op6_license_scan,
    "op6_license_windows": op6_license_windows,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_chat_tree": op8_chat_tree,
    "op9_ngram_join": op9_ngram_join,
    "op10_quality_rules": op10_quality_rules,
    "op11_vector_codes": op11_vector_codes,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_bpe_codec": op13_bpe_codec,
}
