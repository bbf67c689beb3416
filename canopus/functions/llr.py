"""Log-likelihood ratio (Dunning 1993) of a 2x2 contingency table as a Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _cell(k: Column, row: Column, col: Column, n: Column) -> Column:
    k = k.cast("double")
    return F.when(k > 0, k * F.log(k * n / (row * col))).otherwise(F.lit(0.0))


def llr(k11: Column, k12: Column, k21: Column, k22: Column) -> Column:
    """G^2 = 2 (H(rows) + H(cols) - H(cells)) (entropy form), evaluated as the equal but
    cancellation-free sum 2 * sum k_ij ln(k_ij N / (R_i C_j)); clamped at 0."""
    n = (k11 + k12 + k21 + k22).cast("double")
    r1, r2 = (k11 + k12).cast("double"), (k21 + k22).cast("double")
    c1, c2 = (k11 + k21).cast("double"), (k12 + k22).cast("double")
    g = _cell(k11, r1, c1, n) + _cell(k12, r1, c2, n) + _cell(k21, r2, c1, n) + _cell(k22, r2, c2, n)
    return F.greatest(F.lit(2.0) * g, F.lit(0.0))
