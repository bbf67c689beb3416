"""Composite jobs (Q1-Q5) over stage tables in ``out_dir``.

  vectorize_job  parse -> TF -> DF -> prune -> TF-IDF, each stage written (Q1)
  cluster_job    random or canopy seeds -> k-means -> clusters + clustered points (Q2)
  dump_job       top terms + report in the chosen format + raw point dump (Q3)
  run_all        Q1 then Q2 then Q3 (Q4)
  report_job     standalone report from folders: clusters, dictionary, optionally points and
                 vectors (for the evaluation) (Q5)
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopus.config import DumpConfig, KMeansConfig, VectorizeConfig
from canopus.operators import kmeans as km
from canopus.operators.evaluate import evaluation_report, inter_pairs_sparse, inter_stats_of_centers, intra_stats_sparse
from canopus.operators.topk import top_terms
from canopus.operators.vectorize import Stages, doc_terms, term_counts, vectorize
from canopus.plans.reports import dump_clusters, dump_points_lines, write_lines
from canopus.session import intermediates
from canopus.sources.stages import final_clusters, read_dictionary, read_stage, write_stage
from canopus.sources.tags import parse_tag_lines, read_tag_lines


def vectorize_job(spark: SparkSession, path: str | DataFrame, out_dir: str,
                  cfg: VectorizeConfig = VectorizeConfig()) -> Stages:
    lines = read_tag_lines(spark, path) if isinstance(path, str) else path
    tag_docs = parse_tag_lines(lines, cfg)
    write_stage(tag_docs, out_dir, "tagdocs")
    with intermediates(spark):   # what stays is in the stage folders
        st = vectorize(read_stage(spark, out_dir, "tagdocs"), cfg)
        write_stage(st.dictionary, out_dir, "dictionary")
        write_stage(st.tf, out_dir, "tf")
        write_stage(st.df, out_dir, "df")
        write_stage(spark.createDataFrame([(st.n_features, st.n_docs, st.max_df, st.threshold)],
                                          "n_features long, n_docs long, max_df long, threshold long"), out_dir, "stats")
        write_stage(st.pruned, out_dir, "pruned")
        write_stage(st.tfidf, out_dir, "tfidf")
    tag_docs = read_stage(spark, out_dir, "tagdocs")
    dt = doc_terms(tag_docs, cfg)   # no stage of its own: computed again if used
    return replace(st, tag_docs=tag_docs, doc_terms=dt, term_counts=term_counts(dt),
                   **{name: read_stage(spark, out_dir, name) for name in ("dictionary", "tf", "df", "pruned", "tfidf")})


def cluster_job(spark: SparkSession, out_dir: str, cfg: KMeansConfig = KMeansConfig()) -> km.KMeansResult:
    vecs = read_stage(spark, out_dir, "tfidf")
    with intermediates(spark):
        res = _cluster(spark, vecs, out_dir, cfg)
        write_stage(res.centers.withColumn("iter", F.lit(res.iterations)), out_dir, "clusters")
        write_stage(res.points, out_dir, "points")
    return replace(res, centers=read_stage(spark, out_dir, "clusters").drop("iter"), points=read_stage(spark, out_dir, "points"))


def _cluster(spark: SparkSession, vecs: DataFrame, out_dir: str, cfg: KMeansConfig) -> km.KMeansResult:
    if cfg.init == "random":
        pts = km.packed_points(vecs)
        ids = km.random_seeds(pts.select("doc_id"), cfg.k, cfg.seed, "doc_id")
        write_stage(km.seed_centroids_sparse(pts, ids), out_dir, "seeds")
        k = ids.count()
        res = km.kmeans_sparse(pts, read_stage(spark, out_dir, "seeds"), k, cfg, prepared=True)
    elif cfg.init == "canopy":
        from canopus.operators.canopy import kmeans_canopy_sparse
        res, _, seeds = kmeans_canopy_sparse(vecs, cfg)
        write_stage(seeds, out_dir, "seeds")
    else:
        raise ValueError(f"unknown init {cfg.init!r}: 'random' or 'canopy'")
    return res


def report_job(spark: SparkSession, clusters_path: str, dictionary_path: str, out: str,
               cfg: DumpConfig = DumpConfig(), dictionary_fmt: str = "parquet", points_path: str | None = None,
               vectors_path: str | None = None) -> None:
    """Standalone report (Q5): the model and the dictionary (``text`` or ``sequencefile`` /
    ``parquet``) from their folders; without ``points_path`` the clusters are listed alone.
    ``cfg.evaluate`` needs points and vectors."""
    centers = final_clusters(spark.read.parquet(clusters_path)).drop("iter")
    points = spark.read.parquet(points_path) if points_path else None
    terms = top_terms(centers, read_dictionary(spark, dictionary_path, dictionary_fmt), cfg.top_n, cfg.substring)
    evaluation = None
    if cfg.evaluate:
        if points is None or vectors_path is None:
            raise ValueError("the evaluation needs clustered points and their vectors")
        evaluation = evaluation_rows(points, spark.read.parquet(vectors_path), centers, cfg)
    dump_clusters(cfg.fmt, out, points, terms, cfg, clusters=centers, evaluation=evaluation)


def dump_job(spark: SparkSession, out_dir: str, report_dir: str, cfg: DumpConfig = DumpConfig(top_n=50)) -> None:
    base = out_dir.rstrip("/")
    report_job(spark, f"{base}/clusters", f"{base}/dictionary", f"{report_dir}/clusters_dump", cfg.with_(evaluate=False),
               points_path=f"{base}/points")
    points = read_stage(spark, out_dir, "points")
    write_lines(dump_points_lines(points), f"{report_dir}/cluster_points_dump", ["cluster_id", "id"])
    if cfg.evaluate:
        centers = final_clusters(read_stage(spark, out_dir, "clusters")).drop("iter")
        rows = evaluation_rows(points, read_stage(spark, out_dir, "tfidf"), centers, cfg)
        write_lines(rows, f"{report_dir}/cluster_evaluate_result", ["section", "key1", "key2"])


def evaluation_rows(points: DataFrame, vecs: DataFrame, centers: DataFrame, cfg: DumpConfig) -> DataFrame:
    """Evaluation report (E4/K9) over clustered TF-IDF points and the final centres."""
    intra = intra_stats_sparse(points, vecs, cfg.measure, cfg.eval_max_points)
    pairs = inter_pairs_sparse(centers, cfg.measure)
    return evaluation_report(intra, inter_stats_of_centers(centers, cfg.measure), pairs)


def run_all(spark: SparkSession, path: str | DataFrame, out_dir: str, report_dir: str,
            vcfg: VectorizeConfig = VectorizeConfig(), kcfg: KMeansConfig = KMeansConfig(),
            dcfg: DumpConfig = DumpConfig(top_n=50)) -> km.KMeansResult:
    vectorize_job(spark, path, out_dir, vcfg)
    res = cluster_job(spark, out_dir, kcfg)
    dump_job(spark, out_dir, report_dir, dcfg)
    return res


def run(spark: SparkSession, op_type: str, path: str | DataFrame | None, out_dir: str, report_dir: str,
        vcfg: VectorizeConfig = VectorizeConfig(), kcfg: KMeansConfig = KMeansConfig(),
        dcfg: DumpConfig = DumpConfig(top_n=50)):
    """Dispatch on the original operation types: "1" vectorise, "2" cluster, "3" dump,
    anything else all three."""
    if op_type == "1":
        return vectorize_job(spark, path, out_dir, vcfg)
    if op_type == "2":
        return cluster_job(spark, out_dir, kcfg)
    if op_type == "3":
        return dump_job(spark, out_dir, report_dir, dcfg)
    return run_all(spark, path, out_dir, report_dir, vcfg, kcfg, dcfg)
