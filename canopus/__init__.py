"""canopus: tag-document clustering (TF-IDF, k-means, canopy, cluster reports and
evaluation) expressed as Spark DataFrame plans.

Sub-packages
------------
sources    tag-line scans, stage tables, dense point tables
functions  column-expression builders (stop tags, distances, LLR, formatting)
operators  vectorisation, n-grams, k-means, canopy, evaluation, top-k
plans      composite jobs (vectorise / cluster / dump) and report writers
streaming  incremental ingest of tag-line files with Structured Streaming
"""

from canopus.config import DumpConfig, KMeansConfig, VectorizeConfig

__all__ = ["VectorizeConfig", "KMeansConfig", "DumpConfig"]
