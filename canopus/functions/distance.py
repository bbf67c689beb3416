"""Distance measures (the one pluggable function of the original tool).

Each measure has up to three forms:
  dense(x, c)          Column expression over two ARRAY<DOUBLE> columns
  sparse(x2, c2, dot)  Column expression from squared norms and the dot product,
                       used for long-form sparse vectors joined on term id
  tile(A, B)           numpy pairwise matrix used by the tiled pair evaluation
  parts(x2, c2, dot)   numpy form of ``sparse`` (arrays broadcast), used inside tasks

Cosine with a zero vector: distance 0 when both vectors are zero, else 1.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def _zip_sum(x: Column, c: Column, f) -> Column:
    return F.aggregate(F.zip_with(x, c, f), F.lit(0.0), lambda acc, v: acc + v)


def _dense_sq(x, c):
    return _zip_sum(x, c, lambda a, b: (a - b) * (a - b))


def _dense_dot(x, c):
    return _zip_sum(x, c, lambda a, b: a * b)


def cosine_from_parts(x2: Column, c2: Column, dot: Column) -> Column:
    den = F.sqrt(x2) * F.sqrt(c2)
    return (F.when(den == 0, F.when((x2 == 0) & (c2 == 0), F.lit(0.0)).otherwise(F.lit(1.0)))
            .otherwise(F.lit(1.0) - dot / F.greatest(den, dot)))


def _dense_cosine(x, c):
    return cosine_from_parts(_dense_dot(x, x), _dense_dot(c, c), _dense_dot(x, c))


def _sparse_sq(x2, c2, dot):
    return F.greatest(x2 + c2 - F.lit(2.0) * dot, F.lit(0.0))


TILE_CELLS = 4_000_000   # numbers that a tile's working arrays may hold


def _rows(a: np.ndarray, b: np.ndarray, f) -> np.ndarray:
    out = np.empty((a.shape[0], b.shape[0]))
    chunk = max(1, TILE_CELLS // max(1, b.size))
    for i in range(0, a.shape[0], chunk):
        for j in range(0, b.shape[0], max(1, TILE_CELLS // max(1, b.shape[1]))):
            c = b[j:j + max(1, TILE_CELLS // max(1, b.shape[1]))]
            out[i:i + chunk, j:j + len(c)] = f(a[i:i + chunk, None, :] - c[None, :, :])
    return out


def _tile_sq(a, b):
    """One matrix product. Distances far below the squared norms, which the subtraction leaves
    with fewer digits, are computed from the differences."""
    if not a.size or not b.size:
        return np.zeros((a.shape[0], b.shape[0]))
    scale = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :]
    d = a @ b.T
    d *= -2.0
    d += scale
    i, j = np.nonzero(d <= 1e-3 * scale)
    step = max(1, TILE_CELLS // a.shape[1])
    for k in range(0, len(i), step):
        diff = a[i[k:k + step]] - b[j[k:k + step]]
        d[i[k:k + step], j[k:k + step]] = (diff * diff).sum(1)
    return d


def _tile_cosine(a, b):
    dot = a @ b.T
    x2 = (a * a).sum(1)[:, None]
    c2 = (b * b).sum(1)[None, :]
    den = np.sqrt(x2) * np.sqrt(c2)
    with np.errstate(divide="ignore", invalid="ignore"):
        d = 1.0 - dot / np.maximum(den, dot)
    zero = den == 0
    both = (x2 == 0) & (c2 == 0)
    return np.where(zero, np.where(both, 0.0, 1.0), d)


def _parts_sq(x2, c2, dot):
    return np.maximum(x2 + c2 - 2.0 * dot, 0.0)


def _parts_cosine(x2, c2, dot):
    den = np.sqrt(x2) * np.sqrt(c2)
    with np.errstate(divide="ignore", invalid="ignore"):
        d = 1.0 - dot / np.maximum(den, dot)
    return np.where(den == 0, np.where((x2 == 0) & (c2 == 0), 0.0, 1.0), d)


@dataclass(frozen=True)
class Measure:
    name: str
    dense: Callable[[Column, Column], Column]
    sparse: Callable[[Column, Column, Column], Column] | None = None
    tile: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None
    parts: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray] | None = None


_REGISTRY: dict[str, Measure] = {}


def register_distance(name: str, dense, sparse=None, tile=None, parts=None) -> Measure:
    m = Measure(name, dense, sparse, tile, parts)
    _REGISTRY[name] = m
    return m


def distance(name: str) -> Measure:
    try:
        return _REGISTRY[name]
    except KeyError:
        raise ValueError(f"unknown distance measure {name!r}; known: {sorted(_REGISTRY)}") from None


register_distance("sq_euclidean", _dense_sq, _sparse_sq, _tile_sq, _parts_sq)
register_distance("euclidean", lambda x, c: F.sqrt(_dense_sq(x, c)),
                  lambda x2, c2, dot: F.sqrt(_sparse_sq(x2, c2, dot)),
                  lambda a, b: np.sqrt(_tile_sq(a, b)),
                  lambda x2, c2, dot: np.sqrt(_parts_sq(x2, c2, dot)))
register_distance("cosine", _dense_cosine, cosine_from_parts, _tile_cosine, _parts_cosine)
register_distance("manhattan", lambda x, c: _zip_sum(x, c, lambda a, b: F.abs(a - b)), None,
                  lambda a, b: _rows(a, b, lambda d: np.abs(d).sum(-1)))
register_distance("chebyshev", lambda x, c: F.array_max(F.zip_with(x, c, lambda a, b: F.abs(a - b))), None,
                  lambda a, b: _rows(a, b, lambda d: np.abs(d).max(-1)))

__all__ = ["Measure", "distance", "register_distance", "cosine_from_parts"]
