"""From documents to packed sequences: rules, repeated lines, near-duplicates, secrets, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeline.llm import bin_slack, line_dedup, quality, secret_scan, similarity_join
from edgeline.llm.shared_files import ship_code
from edgeline.runtime import materialize


def like(changed: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of `docs`, with n_chars, where there is one, as the text now has it."""
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the rules reject, and without lines that over half of a host's texts share."""
    return like(quality.clean(docs), docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without runs of lines that stand earlier; a document of which no word is left goes."""
    ship_code(spark)
    left = line_dedup.dedup_lines(docs)
    emptied = (F.col("removed_lines") > 0) & (F.col("removed_lines") == F.col("n_lines"))
    return like(left.filter(~emptied), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shingles of five words link at a similarity of 0.8."""
    ship_code(spark)
    return similarity_join.drop_near_duplicates(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    ship_code(spark)
    return like(secret_scan.redact_secrets(docs), docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its place in a sequence."""
    ship_code(spark)
    return bin_slack.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("near dedup", near_dedup),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]

# Tokens, hashed line windows and chosen paths are beyond SQL; the stages are tested by themselves.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over documents, each one's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs, _ = materialize(stage(spark, docs, sf_dir))
    return docs
