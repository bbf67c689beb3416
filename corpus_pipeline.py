"""Corpus pipeline: quality rules, near-duplicates, benchmark decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which :func:`run` writes
as Parquet to the shared folder and reads again as the next one's ``docs``. All but the last
return the columns of ``documents``; the last returns the packed pieces.

Defined results: the stages' own (see their modules); an empty table gives an empty result;
extra columns pass through the filtering stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from canopus.llm import decontaminate, packing, quality, simhash
from canopus.llm.common import read_table
from canopus.llm.queries import PACK_END
from canopus.session import intermediates, new_folder, ship_package


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the rules reject."""
    ship_package(spark)
    return quality.keep_good(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    ship_package(spark)
    return simhash.keep_first(docs, shingle=simhash.SHINGLE, max_bits=simhash.MAX_BITS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents in sequences of 4096 tokens."""
    ship_package(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), PACK_END)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = new_folder(spark, f"pipeline_{name}")
        with intermediates(spark):   # the stage's own tables go; its result stays until it is released
            stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs


#: Near-duplicates, token ids and packing have no SQL form; tests compare with brute force.
ORACLE_SQL = None
