"""Per-cluster limits and listings.

``row_number() <= n`` per cluster is planned by Spark as a WindowGroupLimit: each map
partition keeps at most n rows per cluster before the shuffle, so a cluster holding a
third of all rows never reaches one task whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from canopus.operators.ranking import with_global_index


def cap_points(points: DataFrame, max_points: int | None, cluster_col: str = "cluster_id",
               order_col: str = "doc_id", rank_col: str | None = None) -> DataFrame:
    """First ``max_points`` rows per cluster in ``order_col`` order (None = all)."""
    if max_points is None or max_points < 0:
        return points
    w = Window.partitionBy(cluster_col).orderBy(order_col)
    ranked = points.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= max_points)
    return ranked.withColumnRenamed("_rn", rank_col) if rank_col else ranked.drop("_rn")


def top_terms(centers: DataFrame, dictionary: DataFrame, n: int = 10, substring: int | None = None) -> DataFrame:
    """``(cluster_id, rank, term_id, term, weight)``: the n heaviest centre terms,
    ties broken by term id, decoded through the dictionary."""
    w = Window.partitionBy("cluster_id").orderBy(F.col("weight").desc(), F.col("term_id"))
    top = (centers.select("cluster_id", "term_id", "weight", F.row_number().over(w).alias("rank"))
           .where(F.col("rank") <= n))
    out = dictionary.select("term_id", "term").join(top, "term_id")   # k * n rows; the planner picks the join by size
    term = F.col("term")
    if substring is not None and substring >= 0:
        term = F.substring(term, 1, substring)
    return out.select("cluster_id", F.col("rank").cast("int"), "term_id", term.alias("term"), "weight")


def cluster_sizes(points: DataFrame, cluster_col: str = "cluster_id", clusters: DataFrame | None = None) -> DataFrame:
    """``(cluster_id, n)``; with ``clusters`` (any table with the cluster ids) a row for each of
    them, 0 where no point is assigned."""
    n = points.groupBy(cluster_col).agg(F.count("*").alias("n"))
    if clusters is None:
        return n
    return clusters.select(cluster_col).distinct().join(n, cluster_col, "left").select(cluster_col, F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def member_ranks(points: DataFrame, id_col: str = "doc_id", cluster_col: str = "cluster_id") -> DataFrame:
    """``(cluster_id, id, member_rank)`` 0-based position of each member inside its cluster
    in id order, computed with a distributed global rank (no per-cluster task)."""
    ranked, _ = with_global_index(points.select(cluster_col, id_col), [cluster_col, id_col], "_g")
    starts = ranked.groupBy(cluster_col).agg(F.min("_g").alias("_s"))
    return ranked.join(starts, cluster_col).select(cluster_col, id_col, (F.col("_g") - F.col("_s")).alias("member_rank"))


def member_lines(points: DataFrame, line_points: int = 1000, id_col: str = "doc_id",
                 cluster_col: str = "cluster_id") -> DataFrame:
    """``(cluster_id, chunk, members STRING)``: comma-joined member ids in id order, at most
    ``line_points`` ids per row, so no row grows with the cluster."""
    ranks = member_ranks(points, id_col, cluster_col)
    chunk = F.floor(F.col("member_rank") / line_points).cast("long")
    grouped = ranks.groupBy(cluster_col, chunk.alias("chunk")).agg(
        F.array_sort(F.collect_list(F.struct("member_rank", F.col(id_col).cast("string").alias("id")))).alias("_m"))
    return grouped.select(cluster_col, "chunk", F.array_join(F.transform("_m", lambda s: s["id"]), ",").alias("members"))
