"""The operators of this package as queries over the sample tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from edgeline.llm import (
    alignment,
    best_fit,
    bin_slack,
    divergence,
    lexicon,
    line_dedup,
    posting_lists,
    quality,
    quotes,
    secret_scan,
    similarity_join,
    token_counts,
    url_rules,
)
from edgeline.llm.shared_files import ship_code

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_code(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_code(spark)
        return query(spark, sf_dir)

    return run


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "removed_lines", "removed_words", "text")


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return posting_lists.nearest(vectors, vectors.filter("vec_id % 20 = 0"))


def op3_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.reply_ordered(quotes.link_quotes(table(spark, sf_dir, "conversations")))


def op4_token_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.packed_matrices(table(spark, sf_dir, "documents"))


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_digest(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_digest(table(spark, sf_dir, "documents"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_join.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bin_slack.pack_documents(table(spark, sf_dir, "documents"))


def op10_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.encode_digest(table(spark, sf_dir, "documents"))


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), url_rules.rule_table(spark, url_rules.RULES))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    query.__name__: with_code(query)
    for query in (
        op1_line_dedup,
        op2_nearest_neighbours,
        op3_quotation_linking,
        op4_token_matrices,
        op5_secret_scans,
        op6_token_counts,
        op7_near_dedup,
        op8_quality_rules,
        op9_best_fit_packing,
        op10_bpe_codec,
        op11_url_filters,
        op12_source_divergence,
        op13_tokenizer_alignment,
    )
}

ORACLES: dict[str, str] = {
    "op3_quotation_linking": quotes.ORACLE,
    "op8_quality_rules": quality.ORACLE,
    "op11_url_filters": url_rules.ORACLE,
    "op12_source_divergence": divergence.ORACLE,
}
