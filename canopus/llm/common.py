"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canopus.session import ship_package

#: ASCII white space, the separators of the word rules (fixed value of the contracts).
ASCII_SPACE = r"[\x20\x09-\x0D]+"
#: Bytes of text that a Python task turns into word lists at a time.
CHUNK_BYTES = 2_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(col: Column) -> Column:
    """Words between ASCII white space; null has none."""
    return F.filter(F.split(F.coalesce(col, F.lit("")), ASCII_SPACE), lambda w: w != "")


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z, everything else as it is."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of a binary column of about ``limit`` bytes each, with the place of their first
    value, so that only one run is held as Python objects; null becomes empty."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        held += n
        if held >= limit or i == len(sizes) - 1:
            yield start, [t or b"" for t in column.slice(start, i + 1 - start).to_pylist()]
            start, held = i + 1, 0


#: A table is broadcast if it has at most so many rows and bytes.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 16 << 20


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, marked for broadcast if it has at most ``rows`` rows of at most ``size`` bytes in
    all (measured as JSON, arrays and strings included); beyond that the join is left to Catalyst
    (a shuffle join with skew handling). ``df`` should be a written table."""
    if df.limit(rows + 1).count() > rows:
        return df
    held = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("s")).first()["s"] or 0
    return F.broadcast(df) if held <= size else df


def text_key(text_col: str = "text") -> Column:
    """With the id, tells rows of different texts apart."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def by_key(docs: DataFrame, keys: DataFrame, text: Column, how: str) -> DataFrame:
    """Rows of ``docs`` whose id and ``text`` key are (``left_semi``) or aren't (``left_anti``)
    in ``keys``, a written table of ids and keys. All columns stay as they are."""
    keys = broadcast_if_small(keys)
    own_id, own_key = keys.columns
    return docs.join(keys, docs["doc_id"].eqNullSafe(keys[own_id]) & (text == keys[own_key]), how)
