"""Rows of a vector table that the operators on embeddings can use, as whole numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def whole_vectors(rows: DataFrame, vec_col: str, scale: int, shift: int, limit: int) -> DataFrame:
    """``rows`` with ``x ARRAY<BIGINT>``, each entry ``floor(scale * entry) + shift``, in place of
    ``vec_col``. Left out are rows whose vector is null, holds a null or non-finite entry or one
    with ``|scale * entry| >= limit``, or has another length than most (of equally frequent
    lengths the longest counts; an empty vector has no entry and is left out)."""
    scaled = F.transform(F.col(vec_col), lambda v: v.cast("double") * scale)
    odd = F.exists(F.col(vec_col), lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double") * scale) >= limit))
    good = rows.where(F.col(vec_col).isNotNull() & (F.size(vec_col) > 0)).where(~F.coalesce(odd, F.lit(True)))
    x = F.transform(scaled, lambda v: F.floor(v) + F.lit(shift).cast("long"))
    good = good.select(*(c for c in rows.columns if c != vec_col), x.alias("x"))
    most = good.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return good.where(F.size("x") == (most["d"] if most else 0))
