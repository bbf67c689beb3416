"""Stage tables: one Parquet table per pipeline stage under a caller-given folder.

Each write replaces the previous content of the stage (the original deletes every
stage folder before writing it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STAGES = ("tagdocs", "dictionary", "tf", "df", "stats", "pruned", "tfidf",
          "seeds", "clusters", "points")


def write_stage(df: DataFrame, out_dir: str, name: str) -> str:
    path = f"{out_dir.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(path)
    return path


def read_stage(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{out_dir.rstrip('/')}/{name}")


def read_dictionary(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Dictionary ``(term_id INT, term STRING)``.

    ``text``: tab-separated ``term_id<TAB>term`` lines; ``parquet`` (also accepted
    as ``sequencefile``, the original's binary dictionary): a stage table.
    """
    if fmt == "text":
        raw = spark.read.text(path)
        parts = F.split("value", "\t", 2)
        return raw.select(parts[0].cast("int").alias("term_id"), parts[1].alias("term"))
    if fmt in ("parquet", "sequencefile"):
        return spark.read.parquet(path).select(F.col("term_id").cast("int"), "term")
    raise ValueError(f"Invalid dictionary format: {fmt!r}")


def write_dictionary_text(dictionary: DataFrame, path: str) -> None:
    (dictionary.orderBy("term_id")
     .select(F.concat_ws("\t", F.col("term_id").cast("string"), "term").alias("value"))
     .write.mode("overwrite").text(path))


def final_clusters(clusters: DataFrame) -> DataFrame:
    """Rows of the last iteration of a ``clusters`` table (column ``iter``)."""
    last = clusters.agg(F.max("iter").alias("m")).first()["m"]
    if last is None:
        raise ValueError("no final clusters found")
    return clusters.where(F.col("iter") == F.lit(last))
