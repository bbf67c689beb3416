"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance V of the distinct vectors come from products
``V Q`` with thin blocks Q alone; V is never formed. Such a product is one pass: each task
adds up ``Xc' (Xc Q)`` over its rows, centred before multiplying, and the partial sums (as
many numbers as Q has) are added up by Spark. A few Lanczos steps bound the spectrum from
below. Then, until certified: Rayleigh-Ritz on the block; the polynomial recurrence of the
Chebyshev polynomial on the interval from that bound to the block's smallest Ritz value,
which damps the unwanted eigenvalues in it; QR. A component is certified when the residual
``|V q - e q|`` is within rounding of the largest eigenvalue; iterations go on while they
still lower it by half, as eigenvectors are wanted to double precision.

Entries are whole numbers, so counts, sums and deviations are exact; vectors are centred by
the nearest whole mean first and its remainder then, which loses no digits.

Only matrices of (entries x block) reach the driver, whatever the number of rows.

Defined results: see :func:`.vectors.whole_vectors` for rows that are left out; equal
vectors count once in the fit and are whitened each; components whose eigenvalue is below
``RANK`` times the largest (vectors in a smaller space, a single vector) are not returned;
a deviation beyond 64 bits is null; ties among eigenvalues leave any basis of their space;
an empty table gives an empty result; other columns, texts included, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopus.session import cut_lineage

from .vectors import whole_vectors

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
#: Scaled entries must be below this; sums of them then fit 64 bits for any batch.
LIMIT = 1 << 40
DEGREE, LANCZOS, MAX_ROUNDS = 12, 12, 60
#: Residuals by the largest eigenvalue: good enough to stop once they no longer fall, and as small as rounding allows.
CERTIFIED, ROUNDING = 1e-11, 1e-15
RANK = 1e-10
SCHEMA = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


@dataclass
class Fit:
    """The distinct vectors: their number, exact sums, and the two parts of their mean."""
    table: DataFrame
    n: int
    sums: list[int]

    def __post_init__(self):
        whole = [round(Fraction(s, self.n)) for s in self.sums]
        self.whole = np.array(whole, np.int64)
        self.rest = np.array([float(Fraction(s, self.n) - w) for s, w in zip(self.sums, whole, strict=True)])

    def total(self, of, size: int) -> np.ndarray:
        """The sum over all vectors of ``of(centred rows)``, an array of ``size`` numbers."""
        d, whole, rest = len(self.sums), self.whole, self.rest

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = np.zeros(size)
            for b in batches:
                if b.num_rows:
                    held += of((_matrix(b.column("x"), d) - whole).astype(float) - rest).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(held)], names=["cell", "part"])

        sums = self.table.mapInArrow(add, "cell int, part double").groupBy("cell").agg(F.sum("part").alias("total"))
        out = np.zeros(size)
        got = sums.toPandas()   # ``size`` rows
        out[got["cell"].to_numpy()] = got["total"].to_numpy()
        return out

    def times(self, q: np.ndarray) -> np.ndarray:
        """``V q``: one pass over the vectors."""
        shared = self.table.sparkSession.sparkContext.broadcast(q)
        out = self.total(lambda x: x.T @ (x @ shared.value), q.size).reshape(q.shape) / self.n
        shared.unpersist()
        return out


def fit_list(rows: DataFrame) -> Fit | None:
    """Of a written table with ``x``; null if it is empty."""
    table = cut_lineage(rows.select("x").distinct(), "whitening_fit")
    each = table.select(F.posexplode("x")).groupBy("pos").agg(F.count("*").alias("n"), F.sum(F.col("col").cast("decimal(38,0)")).alias("s"))
    sums = each.orderBy("pos").collect()   # a row per entry of a vector
    return Fit(table, sums[0]["n"], [int(r["s"]) for r in sums]) if sums else None


def lower_bound(fit: Fit, rng: np.random.Generator, steps: int = LANCZOS) -> float:
    """Below the spectrum, or nearly: the least Ritz value of some Lanczos steps less the last residual."""
    d = len(fit.sums)
    q = rng.standard_normal(d)
    basis, alpha, beta = [q / np.linalg.norm(q)], [], []
    for _ in range(min(steps, d)):
        w = fit.times(basis[-1][:, None])[:, 0]
        alpha.append(float(w @ basis[-1]))
        b = np.array(basis)
        for _ in range(2):
            w = w - b.T @ (b @ w)
        beta.append(float(np.linalg.norm(w)))
        if len(basis) == d or beta[-1] <= 1e-12 * max(alpha):
            beta[-1] = 0.0
            break
        basis.append(w / beta[-1])
    t = np.diag(alpha) + np.diag(beta[:-1], 1) + np.diag(beta[:-1], -1)
    return max(0.0, float(np.linalg.eigvalsh(t)[0]) - beta[-1])


def chebyshev(fit: Fit, q: np.ndarray, vq: np.ndarray, low: float, high: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial of V on ``[low, high]`` times ``q``; ``vq`` is ``V q``. Scaled in
    each step by its value at the interval's upper end plus its half width, so nothing overflows."""
    centre, half = (low + high) / 2, (high - low) / 2
    before, now = q, (vq - centre * q) / half
    for _ in range(degree - 1):
        before, now = now, 2 * (fit.times(now) - centre * now) / half - before
        size = np.abs(now).max()
        before, now = before / size, now / size
    return now


def eigenpairs(fit: Fit, components: int = COMPONENTS, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of the covariance, falling, and their unit eigenvectors as columns."""
    d = len(fit.sums)
    k, block = min(components, d), min(2 * components, d)
    rng = np.random.default_rng(seed)
    low = lower_bound(fit, rng) if block < d else 0.0
    q = np.linalg.qr(rng.standard_normal((d, block)))[0]
    best = np.inf
    for _ in range(MAX_ROUNDS):
        vq = fit.times(q)
        e, u = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
        order = np.argsort(-e)
        e, q, vq = e[order], q @ u[:, order], vq @ u[:, order]
        residual = float(np.linalg.norm(vq - q * e, axis=0)[:k].max()) / max(e[0], 1e-300)
        if block == d or residual <= ROUNDING or e[0] <= 0 or (residual <= CERTIFIED and residual > best / 2):
            break
        best = min(best, residual)
        top = max(e[-1], low + 1e-12 * e[0])
        low = min(low, top - 1e-12 * e[0])
        # growth of the largest over the least wanted eigenvalue stays far from 1 / rounding
        reach = lambda v: np.arccosh(max(1.0, (2 * v - top - low) / (top - low)))
        degree = int(np.clip(18 / max(reach(e[0]) - reach(e[k - 1]), 1e-3), 2, DEGREE))
        q = np.linalg.qr(chebyshev(fit, q, vq, low, top, degree))[0]
    else:
        raise RuntimeError(f"no certificate after {MAX_ROUNDS} rounds: residual {residual:.1e}")
    wanted = np.flatnonzero(e[:k] > RANK * max(e[0], 0.0))
    return e[wanted], q[:, wanted]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """``sum((n x - S) ** 2)`` of each row, exact."""
    s = np.array(sums, object)
    widest = max((abs(n * int(v) - t) for row in (x.min(axis=0), x.max(axis=0)) for v, t in zip(row, sums, strict=True)), default=0)
    if widest * widest * len(sums) < 1 << 63:
        diff = n * x - s.astype(np.int64)
        return (diff * diff).sum(axis=1).tolist()
    out = [int(((n * row.astype(object) - s) ** 2).sum()) for row in x]
    return [v if v < 1 << 63 else None for v in out]


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE, shift: int = SHIFT,
           components: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` per usable row
    and component."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("_vec"))
    rows = cut_lineage(whole_vectors(rows, "_vec", scale, shift, LIMIT), "whitening_rows")
    fit = fit_list(rows)
    if fit is None:
        return vectors.sparkSession.createDataFrame([], SCHEMA)
    e, v = eigenpairs(fit, components)
    if not len(e):
        return vectors.sparkSession.createDataFrame([], SCHEMA)
    d, k, n, sums = len(fit.sums), len(e), fit.n, fit.sums
    trace = float(fit.total(lambda x: np.array([(x * x).sum()]), 1)[0]) / n
    to_white = v / np.sqrt(e)

    def squares(x):   # sums of the whitened rows and of their products
        w = x @ to_white
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    got = fit.total(squares, k + k * k) / n
    error = float(np.abs(got[k:].reshape(k, k) - np.outer(got[:k], got[:k]) - np.eye(k)).max())
    whole, rest, explained = fit.whole, fit.rest, e / trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("x"), d)
            if not len(x):
                continue
            white = ((x - whole).astype(float) - rest) @ to_white
            m = len(x) * k
            yield pa.RecordBatch.from_arrays([
                b.column("vec_id").take(pa.array(np.repeat(np.arange(len(x)), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(m, n)), pa.array([t for t in deviations(x, n, sums) for _ in range(k)], pa.int64()),
                pa.array(white.ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(m, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, SCHEMA)
