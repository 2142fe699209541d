"""Registered queries of the training-text operators, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankspark.llm import nearest as nn
from rankspark.llm import (
    audit,
    centroids,
    decontaminate,
    greedy,
    jaccard,
    language,
    packing,
    passages,
    suffixes,
    tokenstore,
    toxicity,
    warc,
)
from rankspark.llm.ship import ship_package
from rankspark.session import fresh_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op3_toxic_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.detect(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_greedy_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return greedy.token_counts(table(spark, sf_dir, "documents"))


def op5_block_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return nn.nearest(rows, rows.filter(F.col("vec_id") % 100 == 0), k=10)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.strip_repeats(table(spark, sf_dir, "documents"), length=100, keep_text=False)


def op7_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "warc")
    warc.write_archives(warc.plan_records(table(spark, sf_dir, "pages")), folder)
    read = warc.read_archives(spark, folder, payload=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_collinear_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.fuzzy_passages(table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op10_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "token-store")
    tokenstore.write(table(spark, sf_dir, "documents"), folder)
    return tokenstore.read(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


def op12_threshold_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return audit.filter_audit(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_language_filters": op2_language_filters,
    "op3_toxic_lexicon": op3_toxic_lexicon,
    "op4_greedy_token_counts": op4_greedy_token_counts,
    "op5_block_nearest": op5_block_nearest,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_warc_dictionary": op7_warc_dictionary,
    "op8_collinear_passages": op8_collinear_passages,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_spaced_seeds": op10_spaced_seeds,
    "op11_token_store": op11_token_store,
    "op12_threshold_centroids": op12_threshold_centroids,
    "op13_filter_audit": op13_filter_audit,
}
