"""Dense point tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as dense points ``(point_id BIGINT, vec ARRAY<DOUBLE>, label INT)``."""
    return (spark.read.parquet(f"{sf_dir}/embeddings.parquet")
            .select(F.col("vec_id").alias("point_id"),
                    F.col("embedding").cast("array<double>").alias("vec"),
                    F.col("label").cast("int").alias("label")))


def gaussian_points(spark: SparkSession, n: int, mx: float, my: float, sd: float,
                    seed: int = 0, num_partitions: int | None = None) -> DataFrame:
    """``n`` 2-d points with x ~ N(mx, sd) and y ~ N(my, sd), generated in parallel.
    Deterministic for a fixed ``seed`` and partition count. Test-data helper."""
    base = spark.range(0, n, 1, num_partitions) if num_partitions else spark.range(n)
    return base.select(F.col("id").alias("point_id"),
                       F.array(F.lit(mx) + F.lit(sd) * F.randn(seed),
                               F.lit(my) + F.lit(sd) * F.randn(seed + 1)).alias("vec"))
