"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, hard_negatives, html_extract, license_scan, mixing, packing, quality, sharding, simhash, token_count,
               token_output, url_filter, whitening)
from .common import read_table
from .oracle import CONTAMINATION_SQL, QUALITY_SQL

#: The id after each document (contracts of packing and of token output).
PACK_END, OUTPUT_END = 1, 2


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read_table(spark, sf_dir, "documents"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents")).drop("text_key")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), PACK_END)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read_table(spark, sf_dir, "documents")).drop("text_key")   # an internal key


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), slop=decontaminate.SLOP)
    return found.drop("text_key")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_uniformly(read_table(spark, sf_dir, "documents"), shards=40)


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.token_output(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), OUTPUT_END)


def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=noisy)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_license_scan, op2_simhash_near_dedup, op3_token_counts, op4_best_fit_packing, op5_quality_rules, op6_benchmark_decontamination,
        op7_html_extraction, op8_url_filters, op9_sharding, op10_token_output, op11_source_mixing, op12_hard_negatives,
        op13_embedding_whitening)
}
#: The others have no SQL form (hash bits, token ids, trained models, random draws, HTML): see the tests.
ORACLE_SQL: dict[str, str] = {"op5_quality_rules": QUALITY_SQL, "op6_benchmark_decontamination": CONTAMINATION_SQL}
