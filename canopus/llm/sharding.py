"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Rows lie in blocks by a hash of their key (about ``block_rows`` each). For each block the
number of its rows that go to each shard is drawn from the exact (multivariate
hypergeometric) law a uniform permutation has, given what earlier blocks took, so the
counts of a shard add up to its size. Rows are permuted within their block and dealt out
by the counts (the exchange), then permuted again within the shard: there by buckets of a
random key, a bucket's first place being the rows of the buckets before it. No block,
shard or bucket needs one task for all its rows to be sorted beyond ``block_rows``.

The main path is DataFrame operations alone; the driver draws one row of counts per block
(``rows / block_rows`` of them) from the blocks' sizes.

Defined results: a null text has no bytes and checksum 0; every row gets a place, repeated
rows too (equal rows are the same, so which has which place is no question); null ids are a
value; a very long text is one row like any other; an empty table gives an empty result;
columns other than id and text are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from canopus.session import cut_lineage

BLOCK_ROWS = 100_000
#: Above so many rows left the library's draw is not defined; places are drawn instead.
LIBRARY_ROWS = 10**9
OVERHEAD_BYTES = 16


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Sizes at most one apart."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def communication_matrix(blocks: list[tuple[int, int]], sizes: list[int], seed: int) -> list[tuple[int, list[int]]]:
    """``(block, upper ends)``: the block's row with rank ``r`` (from 0) goes to the first
    shard whose end is above ``r``. Blocks are ``(block, rows)``."""
    rng = np.random.Generator(np.random.PCG64(seed))
    left = np.array(sizes, np.int64)
    out = []
    for block, rows in sorted(blocks):
        drawn = (rng.multivariate_hypergeometric(left, rows, method="marginals") if left.sum() < LIBRARY_ROWS
                 else places_drawn(rng, left, rows))
        left -= drawn
        out.append((block, np.cumsum(drawn).tolist()))
    return out


def places_drawn(rng: np.random.Generator, left: np.ndarray, rows: int) -> np.ndarray:
    """The same law for any total: ``rows`` different places of those left, each a shard's."""
    places = np.unique(rng.integers(left.sum(), size=rows))
    while len(places) < rows:
        places = np.union1d(places, rng.integers(left.sum(), size=rows - len(places)))
    return np.bincount(np.searchsorted(np.cumsum(left), places, "right"), minlength=len(left))


def shard_uniformly(docs: DataFrame, shards: int = 40, seed: int = 7, block_rows: int = BLOCK_ROWS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` per row: the law is
    ``rows``, a shard's slots run from 0 without gaps."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    # a row's number is stored with it, so that equal rows (one may be a third of all) spread over the blocks
    rows = cut_lineage(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + OVERHEAD_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.monotonically_increasing_id().alias("row")), "shard_rows")
    n, parallel = rows.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))

    def mixed(salt: int):
        return F.xxhash64(F.lit(seed * 8 + salt), "row")

    n_blocks = max(parallel, math.ceil(n / block_rows))
    rows = rows.withColumn("block", F.pmod(mixed(0), F.lit(n_blocks)))
    counts = [(r["block"], r["n"]) for r in rows.groupBy("block").agg(F.count("*").alias("n")).collect()]
    sizes = shard_sizes(n, shards)
    matrix = spark.createDataFrame(communication_matrix(counts, sizes, seed), "block bigint, ends array<bigint>")
    in_block = Window.partitionBy("block").orderBy(mixed(1), "row")
    dealt = (rows.withColumn("r", F.row_number().over(in_block) - 1)
             .join(matrix, "block")
             .withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("r"))))
             .select("doc_id", "size", "text_crc32", "row", "shard"))
    n_buckets = max(math.ceil(parallel / shards), math.ceil(max(sizes) / block_rows))
    dealt = cut_lineage(dealt.withColumn("bucket", F.pmod(mixed(2), F.lit(n_buckets))), "shard_dealt")
    in_shard = Window.partitionBy("shard").orderBy("bucket")   # a row per bucket
    firsts = (dealt.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
              .select("shard", "bucket", (F.sum("n").over(in_shard) - F.col("n")).alias("before")))
    in_bucket = Window.partitionBy("shard", "bucket").orderBy(mixed(3), "row")
    return (dealt.withColumn("r", F.row_number().over(in_bucket) - 1)
            .join(firsts, ["shard", "bucket"])
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
                    (F.col("before") + F.col("r")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
