"""Dense global positions without a single-partition window.

``row_number() OVER (ORDER BY ...)`` with no partition moves every row into one task.
Here the rows are range-sorted across all partitions, each row gets its partition id and
its place inside the partition, the result is checkpointed (so the partition layout is
fixed), and only one count per partition is sent to the driver to build the offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopus.session import cut_lineage


def with_global_index(df: DataFrame, order_cols: list[str | Column], name: str = "idx") -> tuple[DataFrame, int]:
    """Return ``(df + name BIGINT 0-based position in order_cols order, row count)``.
    ``order_cols`` must make the order total for the positions to be deterministic."""
    cols = df.columns
    tagged = cut_lineage(df.orderBy(*order_cols).select(
        "*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid")))
    counts = {r["_pid"]: r["count"] for r in tagged.groupBy("_pid").count().collect()}
    if not counts:
        return tagged.select(*cols, F.lit(0).cast("long").alias(name)), 0
    offsets, total = [], 0
    for p in range(max(counts) + 1):
        offsets.append(total)
        total += counts.get(p, 0)
    start = F.element_at(F.array(*[F.lit(o).cast("long") for o in offsets]), F.col("_pid") + 1)
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return tagged.select(*cols, (start + local).alias(name)), total


BROADCAST_BYTES = 64 << 20


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only when the measured size of the rows (strings by their bytes, other
    values 8 each) is within ``max_bytes``; otherwise the planner keeps a shuffle join (AQE
    may still convert it). ``df`` should be a written table."""
    total = df.agg(F.sum(_row_bytes(df)).alias("s")).first()["s"] or 0
    return F.broadcast(df) if total <= max_bytes else df


def _row_bytes(df: DataFrame) -> Column:
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) + 16 if t == "string" else F.lit(8) for c, t in df.dtypes), F.lit(16))
    return size.cast("long")


def lookup_join(rows: DataFrame, table: DataFrame, keys: list[str], frequency: Column, max_bytes: int | None = None) -> DataFrame:
    """``rows`` joined with ``table``, which has a row a key and, as ``frequency`` (at least 1), about
    how many ``rows`` have it. A table within ``max_bytes`` is broadcast. Of a larger one the frequent
    keys are, so that only rows of rare keys, few as words go, are shuffled; both should be written tables."""
    max_bytes = BROADCAST_BYTES if max_bytes is None else max_bytes
    power = F.coalesce(F.floor(F.log2(frequency)).cast("int"), F.lit(0))
    left, hot = max_bytes, None
    for r in table.groupBy(power.alias("p")).agg(F.sum(_row_bytes(table)).alias("s")).orderBy(F.desc("p")).collect():   # a row a power of two
        left -= r["s"]
        if left < 0:
            break
        hot = r["p"]
    if left >= 0:
        return rows.join(F.broadcast(table), keys)
    if hot is None:
        return rows.join(table, keys)
    common = table.where(power >= hot)
    rare = rows.join(F.broadcast(common.select(*keys)), keys, "left_anti").join(table.where(power < hot), keys)
    return rows.join(F.broadcast(common), keys).unionByName(rare)
