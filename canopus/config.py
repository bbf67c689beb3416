"""Run parameters as frozen dataclasses.

Defaults are the effective defaults of the original command-line tool (its parser
overwrites the field initialisers): min support 2, n-gram size 1, min DF 1, max DF
99 %, no sigma, k 3, delta 0.01, 3 iterations, squared Euclidean distance.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from canopus.functions.stopwords import DEFAULT_STOP_TERMS


@dataclass(frozen=True)
class VectorizeConfig:
    # line parsing
    sep: str = "|"
    min_fields: int = 50            # a line needs this many fields, id included
    drop_last_field: bool = True    # the last field of a line is never a tag
    stop_terms: tuple[str, ...] = DEFAULT_STOP_TERMS
    drop_years: bool = True
    # vocabulary
    min_support: int = 2
    max_ngram: int = 1
    min_llr: float = 1.0
    # document-frequency pruning
    min_df: int = 1
    max_df_percent: int = 99
    max_df_sigma: float | None = None
    second_df_filter: bool = True   # the weighting step applies max_df_percent again
    # weighting
    scheme: str = "classic"         # "classic" sqrt(tf)*(1+ln(N/(df+1))); "smooth" tf*ln((N+1)/(df+1))
    norm: float | str | None = None  # p >= 0 or "INF"
    log_normalize: bool = False

    def with_(self, **kw) -> "VectorizeConfig":
        return replace(self, **kw)


@dataclass(frozen=True)
class KMeansConfig:
    k: int = 3
    delta: float = 0.01
    max_iter: int = 3
    measure: str = "sq_euclidean"
    seed: int = 42
    threshold: float = 0.0          # classification threshold; 0 keeps every point
    init: str = "random"            # "random" or "canopy"
    canopy_fraction: float = 0.1    # share of vectors sampled to estimate T1/T2
    canopy_factor: float = 1.3      # T1 = factor * mean sampled distance, T2 = T1 / 2
    canopy_block_points: int = 5_000  # points one greedy pass decides; the result does not depend on it
    broadcast_max_values: int = 8_000_000  # centroid cells (terms x k) allowed in a broadcast, for a sparse measure without a numpy form
    array_max_k: int = 32           # dense centres inlined as literals up to this k

    def with_(self, **kw) -> "KMeansConfig":
        return replace(self, **kw)


@dataclass(frozen=True)
class DumpConfig:
    fmt: str = "TEXT"               # TEXT, CSV, GRAPH_ML, JSON
    top_n: int = 10
    substring: int | None = None    # label truncation; None or negative = unlimited
    max_points: int | None = None   # points listed per cluster; None = all
    evaluate: bool = False
    eval_max_points: int | None = None  # None: exact averages over all points; n: also min, max, density of the first n
    measure: str = "sq_euclidean"
    line_points: int = 1000         # CSV/JSON member lists are cut into lines of this many ids

    def with_(self, **kw) -> "DumpConfig":
        return replace(self, **kw)


# The worked example documented by the original tool (vectorise -s 5 -md 3 -x 50;
# cluster -k 4 -mi 10 -delta 0.1 with cosine distance; dump -n 50).
WORKED_VECTORIZE = VectorizeConfig(min_support=5, min_df=3, max_df_percent=50)
WORKED_KMEANS = KMeansConfig(k=4, max_iter=10, delta=0.1, measure="cosine")
WORKED_DUMP = DumpConfig(top_n=50)

__all__ = [
    "VectorizeConfig", "KMeansConfig", "DumpConfig",
    "WORKED_VECTORIZE", "WORKED_KMEANS", "WORKED_DUMP", "field",
]
