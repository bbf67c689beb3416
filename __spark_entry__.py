"""

Every query reads the driver tables (``documents``, ``embeddings``) whole. Upstream
stages shared by several queries (vectorisation, k-means) are computed once per
session and data folder and reused.
"""

from __future__ import annotations

import importlib
import os
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle_sql as O  # noqa: E402
from canopus.config import DumpConfig, KMeansConfig, VectorizeConfig  # noqa: E402
from canopus.functions.distance import distance  # noqa: E402
from canopus.operators import canopy as cn  # noqa: E402
from canopus.operators import evaluate as ev  # noqa: E402
from canopus.operators import kmeans as km  # noqa: E402
from canopus.operators import ngrams as ng  # noqa: E402
from canopus.operators import topk as tk  # noqa: E402
from canopus.operators import vectorize as vz  # noqa: E402
from canopus.plans import pipeline as pl  # noqa: E402
from canopus.plans import reports as rp  # noqa: E402
from canopus.session import ensure_checkpoint_dir, ship_package  # noqa: E402
from canopus.sources import stages  # noqa: E402
from canopus.sources.points import read_embeddings  # noqa: E402
from canopus.sources.tags import (  # noqa: E402
    documents_as_tag_lines,
    documents_tag_docs,
    parse_tag_lines,
    read_documents,
    read_tag_lines,
    tag_tokens,
)  # noqa: E402


def _optional(module: str):
    """The module, or None where it (or a package above it) is not there."""
    try:
        return importlib.import_module(module)
    except ModuleNotFoundError as e:
        if e.name and f"{module}.".startswith(f"{e.name}."):
            return None
        raise


llm_queries = _optional("canopus.llm.queries")
corpus_pipeline = _optional("corpus_pipeline") if llm_queries else None

# ----------------------------------------------------------------------------- parameters
DEFAULT_V = VectorizeConfig()                                             # parser defaults
WORKED_V = VectorizeConfig(min_support=5, min_df=3, max_df_percent=50)    # documented example
STOP_V = VectorizeConfig(stop_terms=("the", "in", "en", "and", "to"))     # stop tags that occur in the data
SIGMA_V = WORKED_V.with_(max_df_sigma=3.0)
KM_DEFAULT = KMeansConfig()                                               # k 3, delta 0.01, 3 iterations, sq. Euclidean
KM_WORKED = KMeansConfig(k=4, max_iter=10, delta=0.1, measure="cosine")   # documented example
KM_DENSE = KMeansConfig(k=10)
KM_SPARSE_CANOPY = KM_WORKED.with_(measure="sq_euclidean")             # canopy seeding of the TF-IDF vectors
DUMP = DumpConfig(top_n=50, line_points=100)
CAP = 25
EVAL_CAP = 1000
EMPTY_WEIGHT = 0.5      # centre of a cluster that stays empty, on the first term
SUBSTRING = 3
THRESHOLD = 0.52        # of 1 / (1 + distance)

_memo: dict = {}


def _key(spark, sf, *rest):
    return (id(spark.sparkContext), sf) + rest


def _stages(spark, sf, cfg: VectorizeConfig) -> vz.Stages:
    k = _key(spark, sf, "stages", cfg)
    if k not in _memo:
        _memo[k] = vz.vectorize(documents_tag_docs(spark, sf, cfg), cfg)
    return _memo[k]


def _packed(spark, sf, cfg: VectorizeConfig) -> DataFrame:
    k = _key(spark, sf, "points", cfg)
    if k not in _memo:
        _memo[k] = km.packed_points(_stages(spark, sf, cfg).tfidf)
    return _memo[k]


def _points(spark, sf, cfg: VectorizeConfig) -> DataFrame:
    return km.long_form(_packed(spark, sf, cfg))


def _seeds(spark, sf, cfg, kc):
    pts = _packed(spark, sf, cfg)
    return km.random_seeds(pts.select("doc_id"), kc.k, kc.seed, "doc_id")


def _kmeans(spark, sf, cfg, kc) -> km.KMeansResult:
    k = _key(spark, sf, "kmeans", cfg, kc)
    if k not in _memo:
        pts = _packed(spark, sf, cfg)
        seeds = _seeds(spark, sf, cfg, kc)
        _memo[k] = km.kmeans_sparse(pts, km.seed_centroids_sparse(pts, seeds), kc.k, kc, prepared=True)
    return _memo[k]


def _emb(spark, sf):
    return read_embeddings(spark, sf)


def _kdense(spark, sf, kc) -> km.KMeansResult:
    k = _key(spark, sf, "kdense", kc)
    if k not in _memo:
        _memo[k] = km.kmeans_dense_random(_emb(spark, sf), kc)
    return _memo[k]


def _r(c, d=6):
    return F.round(F.col(c), d).alias(c)


def _top_terms(spark, sf):
    res = _kmeans(spark, sf, WORKED_V, KM_WORKED)
    cent = res.centers.select("cluster_id", "term_id", F.round("weight", 9).alias("weight"))
    return tk.top_terms(cent, _stages(spark, sf, WORKED_V).dictionary, DUMP.top_n)


def _clustered(spark, sf):
    res = _kmeans(spark, sf, WORKED_V, KM_WORKED)
    return res.points.select("cluster_id", "doc_id", "weight", F.round("distance", 6).alias("distance"))


def _label_points(spark, sf):
    return _emb(spark, sf).select(F.col("label").alias("cluster_id"), "point_id", "vec")


def _label_centers(spark, sf):
    return ev.label_centroids(_emb(spark, sf), "label")


# ----------------------------------------------------------------------------- queries

def q_tag_parse(spark, sf):
    return tag_tokens(documents_tag_docs(spark, sf, DEFAULT_V))


def q_stop_filter(spark, sf):
    return tag_tokens(documents_tag_docs(spark, sf, STOP_V))


def q_term_counts(spark, sf):
    return _stages(spark, sf, DEFAULT_V).term_counts


def q_dictionary(spark, sf):
    return _stages(spark, sf, WORKED_V).dictionary


def q_term_frequency(spark, sf):
    return _stages(spark, sf, WORKED_V).tf


def q_document_frequency(spark, sf):
    return _stages(spark, sf, WORKED_V).df


def q_corpus_stats(spark, sf):
    return vz.corpus_stats(_stages(spark, sf, WORKED_V).tf)


def q_df_sigma(spark, sf):
    return vz.df_sigma(_stages(spark, sf, WORKED_V).df).select("n_terms", _r("sigma_std"))


def _threshold_q(spark, sf, cfg):
    st = _stages(spark, sf, cfg)
    max_df = F.lit(int(st.max_df)).cast("long")
    return vz.corpus_stats(st.tf).select("n_docs", max_df.alias("max_df"),
                                         vz.max_df_threshold_col(F.col("n_docs"), max_df).alias("threshold"))


def q_max_df_threshold(spark, sf):
    return _threshold_q(spark, sf, DEFAULT_V)


def q_max_df_threshold_sigma(spark, sf):
    return _threshold_q(spark, sf, SIGMA_V)


def q_prune_by_df(spark, sf):
    return _stages(spark, sf, WORKED_V).pruned


def _tfidf_q(cfg):
    def q(spark, sf):
        return _stages(spark, sf, cfg).tfidf.select("doc_id", "term_id", _r("weight"))
    return q


def q_ngrams_llr(spark, sf):
    docs = documents_tag_docs(spark, sf, DEFAULT_V)
    s = ng.llr_scores(docs, min_count=DEFAULT_V.min_support).where((F.col("k11") >= DEFAULT_V.min_support) & (F.col("llr") >= DEFAULT_V.min_llr))
    return s.select("gram", "k11", _r("llr"))


def _distance_q(measure):
    def q(spark, sf):
        pts = _emb(spark, sf)
        cent = _label_centers(spark, sf).withColumnRenamed("cluster_id", "label")
        d = distance(measure).dense(F.col("vec"), F.col("center"))
        return pts.join(cent, "label").select("point_id", F.round(d, 6).alias("distance"))
    return q


def q_random_seeds(spark, sf):
    return _seeds(spark, sf, WORKED_V, KM_WORKED)


def q_assign_sparse(spark, sf):
    pts = _packed(spark, sf, WORKED_V)
    cent = km.seed_centroids_sparse(pts, _seeds(spark, sf, WORKED_V, KM_WORKED))
    st = km.sparse_center_stats(cent, cent)
    c2 = [st[j]["n2"] for j in range(KM_WORKED.k)]
    rows = km.assign_sparse_rows(pts, cent, KM_WORKED.k, c2, KM_WORKED.measure)
    return rows.where("_first").select("doc_id", "cluster_id", F.round("distance", 6).alias("distance"))


def q_update_centroids(spark, sf):
    pts = _packed(spark, sf, WORKED_V)
    cent = km.seed_centroids_sparse(pts, _seeds(spark, sf, WORKED_V, KM_WORKED))
    st = km.sparse_center_stats(cent, cent)
    c2 = [st[j]["n2"] for j in range(KM_WORKED.k)]
    rows = km.assign_sparse_rows(pts, cent, KM_WORKED.k, c2, KM_WORKED.measure)
    return km.update_sparse(rows, cent).select("cluster_id", "term_id", _r("weight"))


def q_assign_dense(spark, sf):
    emb = _emb(spark, sf)
    centers = km.dense_seed_centers(emb, KM_DENSE.k, KM_DENSE.seed)
    return km.assign_dense(emb, centers, KM_DENSE.measure).select("point_id", "cluster_id", _r("distance"))


def q_kmeans_dense_3iter(spark, sf):
    return _kdense(spark, sf, KM_DENSE).points.select("cluster_id", "point_id", _r("distance", 4))


def q_kmeans_sparse_3iter(spark, sf):
    return _kmeans(spark, sf, WORKED_V, KM_DEFAULT).points.select("cluster_id", "doc_id", _r("distance", 4))


def q_kmeans_worked(spark, sf):
    return _kmeans(spark, sf, WORKED_V, KM_WORKED).points.select("cluster_id", "doc_id", _r("distance", 4))


def q_kmeans_worked_long(spark, sf):
    """The worked example through the long-form (many-centre) assignment."""
    return _kmeans(spark, sf, WORKED_V, KM_WORKED.with_(array_max_k=0)).points.select(
        "cluster_id", "doc_id", _r("distance", 4))


def q_kmeans_canopy_sparse(spark, sf):
    res, _, _ = cn.kmeans_canopy_sparse(_points(spark, sf, WORKED_V), KM_SPARSE_CANOPY, prepared=True)
    return res.points.select("cluster_id", "doc_id", _r("distance", 4))


def q_cap_points(spark, sf):
    return tk.cap_points(_label_points(spark, sf).select("cluster_id", "point_id"), CAP, order_col="point_id")


def q_top_terms(spark, sf):
    return _top_terms(spark, sf).select("cluster_id", "rank", "term_id", "term", _r("weight"))


def q_members(spark, sf):
    return tk.member_ranks(_clustered(spark, sf), "doc_id")


def q_cluster_sizes(spark, sf):
    return tk.cluster_sizes(_clustered(spark, sf))


def _intra_cols(s):
    return s.select("cluster_id", "n_total", "n_used", "n_pairs", _r("avg_dist"), _r("min_dist"), _r("max_dist"), _r("density"))


def q_intra_stats_capped(spark, sf):
    """A cap below every cluster's size."""
    return _intra_cols(ev.intra_stats(_label_points(spark, sf), "sq_euclidean", CAP))


def q_intra_avg_full(spark, sf):
    s = ev.intra_stats(_label_points(spark, sf), "sq_euclidean")
    return s.select("cluster_id", "n_total", "n_used", "n_pairs", _r("avg_dist"))


def q_intra_stats_full(spark, sf):
    return _intra_cols(ev.intra_stats_full(_label_points(spark, sf), "sq_euclidean"))


def q_intra_avg_full_manhattan(spark, sf):
    s = ev.intra_stats(_label_points(spark, sf), "manhattan")
    return s.select("cluster_id", "n_total", "n_used", "n_pairs", _r("avg_dist"))


def q_intra_avg_full_sparse(spark, sf):
    s = ev.intra_stats_sparse(_clustered(spark, sf).select("cluster_id", "doc_id"), _points(spark, sf, WORKED_V), KM_WORKED.measure)
    return s.select("cluster_id", "n_total", "n_used", "n_pairs", _r("avg_dist"))


def q_kmeans_dense_manhattan(spark, sf):
    return _kdense(spark, sf, KM_DENSE.with_(measure="manhattan")).points.select("cluster_id", "point_id", _r("distance", 4))


def q_intra_stats(spark, sf):
    s = ev.intra_stats(_label_points(spark, sf), "sq_euclidean", EVAL_CAP)
    return _intra_cols(s)


def _pairs(spark, sf):
    return ev.inter_pairs(_label_centers(spark, sf), "sq_euclidean")


def q_inter_pairs(spark, sf):
    return _pairs(spark, sf).select("cluster_id_1", "cluster_id_2", _r("distance"))


def q_inter_stats(spark, sf):
    s = ev.inter_stats_of_centers(_label_centers(spark, sf), "sq_euclidean")
    return s.select("n_pairs", _r("max_dist"), _r("min_dist"), _r("avg_dist"), _r("density"))


def q_intra_stats_sparse(spark, sf):
    pts = _clustered(spark, sf).select("cluster_id", "doc_id")
    s = ev.intra_stats_sparse(pts, _points(spark, sf, WORKED_V), KM_WORKED.measure, EVAL_CAP)
    return _intra_cols(s)


def _pairs_sparse(spark, sf):
    return ev.inter_pairs_sparse(_kmeans(spark, sf, WORKED_V, KM_WORKED).centers, KM_WORKED.measure)


def q_inter_pairs_sparse(spark, sf):
    return _pairs_sparse(spark, sf).select("cluster_id_1", "cluster_id_2", _r("distance"))


def q_inter_stats_sparse(spark, sf):
    s = ev.inter_stats_of_centers(_kmeans(spark, sf, WORKED_V, KM_WORKED).centers, KM_WORKED.measure)
    return s.select("n_pairs", _r("max_dist"), _r("min_dist"), _r("avg_dist"), _r("density"))


def q_evaluate_report(spark, sf):
    intra = ev.intra_stats(_label_points(spark, sf), "sq_euclidean", EVAL_CAP)
    pairs = _pairs(spark, sf)
    return ev.evaluation_report(intra, ev.inter_stats_of_centers(_label_centers(spark, sf), "sq_euclidean"), pairs)


def _model(spark, sf, empty: bool):
    """Points, the model's cluster ids with sizes, and top terms; ``empty`` adds a cluster that
    no document is assigned to (its centre is far from all of them)."""
    pts, centers = _clustered(spark, sf), _kmeans(spark, sf, WORKED_V, KM_WORKED).centers
    if empty:
        centers = centers.unionByName(spark.range(1).select(
            F.lit(KM_WORKED.k).alias("cluster_id"), F.lit(0).alias("term_id"), F.lit(EMPTY_WEIGHT).alias("weight")))
    rounded = centers.select("cluster_id", "term_id", F.round("weight", 9).alias("weight"))
    terms = tk.top_terms(rounded, _stages(spark, sf, WORKED_V).dictionary, DUMP.top_n)
    return pts, tk.cluster_sizes(pts, clusters=centers), terms


def _report_q(kind, empty=False, cfg=DUMP):
    def q(spark, sf):
        pts, sizes, terms = _model(spark, sf, empty)
        if kind == "text":
            return rp.report_text(terms, pts, sizes, cfg)
        if kind == "csv":
            return rp.report_csv(pts, cfg, sizes=sizes)
        if kind == "json":
            return rp.report_json(terms, pts, sizes, cfg)
        return rp.report_graph(pts, sizes, cfg, terms=terms)[kind == "edges"]
    return q


# ------------------------------------------------------------------ stage folders

def _folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/stages_{uuid.uuid4().hex}"


def q_tag_lines_text(spark, sf):
    """Tag lines written to and scanned from text files."""
    out = _folder(spark)
    documents_as_tag_lines(read_documents(spark, sf)).write.text(out)
    return tag_tokens(parse_tag_lines(read_tag_lines(spark, out), DEFAULT_V))


def _stage_q(name, make, back=lambda df: df):
    def q(spark, sf):
        out = _folder(spark)
        stages.write_stage(make(spark, sf), out, name)
        return back(stages.read_stage(spark, out, name))
    return q


q_stage_tagdocs = _stage_q("tagdocs", lambda spark, sf: documents_tag_docs(spark, sf, DEFAULT_V), tag_tokens)
q_stage_vectors = _stage_q("tfidf", lambda spark, sf: _stages(spark, sf, WORKED_V).tfidf,
                           lambda df: df.select("doc_id", "term_id", _r("weight")))
q_stage_seeds = _stage_q("seeds", lambda spark, sf: km.seed_centroids_sparse(_points(spark, sf, WORKED_V), _seeds(spark, sf, WORKED_V, KM_WORKED)),
                         lambda df: df.select("cluster_id", "term_id", _r("weight")))


def q_stage_final_clusters(spark, sf):
    """The last of several iterations in a clusters folder."""
    out = _folder(spark)
    seeds = km.seed_centroids_sparse(_points(spark, sf, WORKED_V), _seeds(spark, sf, WORKED_V, KM_WORKED))
    last = _kmeans(spark, sf, WORKED_V, KM_WORKED).centers
    both = seeds.withColumn("iter", F.lit(0)).unionByName(last.withColumn("iter", F.lit(10))).unionByName(seeds.withColumn("iter", F.lit(9)))
    stages.write_stage(both, out, "clusters")
    return stages.final_clusters(stages.read_stage(spark, out, "clusters")).select("cluster_id", "term_id", _r("weight"))


def q_dictionary_text(spark, sf):
    out = _folder(spark)
    stages.write_dictionary_text(_stages(spark, sf, WORKED_V).dictionary, out)
    return stages.read_dictionary(spark, out, "text")


def q_dictionary_parquet(spark, sf):
    out = _folder(spark)
    stages.write_stage(_stages(spark, sf, WORKED_V).dictionary, out, "dictionary")
    return stages.read_dictionary(spark, f"{out}/dictionary", "sequencefile")


def q_kmeans_threshold(spark, sf):
    res = _kmeans(spark, sf, WORKED_V, KM_WORKED.with_(threshold=THRESHOLD))
    return res.points.select("cluster_id", "doc_id", _r("distance", 4))


def q_dump_points(spark, sf):
    return rp.dump_points_lines(_clustered(spark, sf))


def q_estimate_t(spark, sf):
    t = cn.estimate_t(_emb(spark, sf), KM_DENSE.canopy_fraction, KM_DENSE.canopy_factor, "sq_euclidean", KM_DENSE.seed)
    return t.select("n_sample", _r("avg_distance"), _r("t1"), _r("t2"))


def q_canopy_centers(spark, sf):
    emb = _emb(spark, sf)
    t = cn.estimate_t(emb, KM_DENSE.canopy_fraction, KM_DENSE.canopy_factor, "sq_euclidean", KM_DENSE.seed).first()
    c = cn.canopy_centers(emb, t["t1"], t["t2"], "sq_euclidean")
    return c.select("cluster_id", F.transform("center", lambda x: F.round(x, 6) + 0.0).alias("center"))


def q_kmeans_canopy(spark, sf):
    res, _, _ = cn.kmeans_canopy(_emb(spark, sf), KM_DENSE)
    return res.points.select("cluster_id", "point_id", _r("distance", 4))


def _t_sparse(spark, sf):
    return cn.estimate_t_sparse(_points(spark, sf, WORKED_V), KM_WORKED.canopy_fraction, KM_WORKED.canopy_factor,
                                KM_SPARSE_CANOPY.measure, KM_WORKED.seed)


def q_estimate_t_sparse(spark, sf):
    return _t_sparse(spark, sf).select("n_sample", _r("avg_distance"), _r("t1"), _r("t2"))


def q_canopy_centers_sparse(spark, sf):
    t = _t_sparse(spark, sf).first()
    c = cn.canopy_centers_sparse(_points(spark, sf, WORKED_V), t["t1"], t["t2"], KM_SPARSE_CANOPY.measure)
    return c.select("cluster_id", "term_id", _r("weight"))


# ------------------------------------------------------------------ jobs over folders

def _job(spark, sf) -> tuple[str, str]:
    """Folders of stages and reports that the whole job wrote from tag lines in text files."""
    k = _key(spark, sf, "job")
    if k not in _memo:
        base = _folder(spark)
        documents_as_tag_lines(read_documents(spark, sf)).write.text(f"{base}/lines")
        pl.run(spark, "all", f"{base}/lines", f"{base}/job", f"{base}/reports", WORKED_V, KM_WORKED, DUMP.with_(fmt="CSV"))
        _memo[k] = f"{base}/job", f"{base}/reports"
    return _memo[k]


def q_job_vectorize(spark, sf):
    return stages.read_stage(spark, _job(spark, sf)[0], "tfidf").select("doc_id", "term_id", _r("weight"))


def q_job_cluster(spark, sf):
    return stages.read_stage(spark, _job(spark, sf)[0], "points").select("cluster_id", "doc_id", _r("distance", 4))


def q_job_dump(spark, sf):
    """The report's lines, as written."""
    return spark.read.text(f"{_job(spark, sf)[1]}/clusters_dump").select(F.col("value").alias("line"))


def q_job_report(spark, sf):
    """The standalone report over folders, with a dictionary that went through text."""
    job, _ = _job(spark, sf)
    out = _folder(spark)
    stages.write_dictionary_text(stages.read_dictionary(spark, f"{job}/dictionary"), f"{out}/dictionary")
    pl.report_job(spark, f"{job}/clusters", f"{out}/dictionary", f"{out}/report", DUMP.with_(fmt="CSV"), "text", f"{job}/points")
    return spark.read.text(f"{out}/report").select(F.col("value").alias("line"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "job_vectorize": q_job_vectorize,
    "job_cluster": q_job_cluster,
    "job_dump": q_job_dump,
    "job_report": q_job_report,
    "tag_parse": q_tag_parse,
    "stop_filter": q_stop_filter,
    "term_counts": q_term_counts,
    "dictionary": q_dictionary,
    "term_frequency": q_term_frequency,
    "document_frequency": q_document_frequency,
    "corpus_stats": q_corpus_stats,
    "df_sigma": q_df_sigma,
    "max_df_threshold": q_max_df_threshold,
    "max_df_threshold_sigma": q_max_df_threshold_sigma,
    "prune_by_df": q_prune_by_df,
    "tfidf": _tfidf_q(WORKED_V),
    "tfidf_default": _tfidf_q(DEFAULT_V),
    "tfidf_smooth": _tfidf_q(WORKED_V.with_(scheme="smooth")),
    "tfidf_norm2": _tfidf_q(WORKED_V.with_(norm=2)),
    "tfidf_norm_inf": _tfidf_q(WORKED_V.with_(norm="INF")),
    "tfidf_lognorm": _tfidf_q(WORKED_V.with_(norm=2, log_normalize=True)),
    "tfidf_sigma": _tfidf_q(SIGMA_V),
    "tfidf_bigrams": _tfidf_q(WORKED_V.with_(max_ngram=2)),
    "tfidf_trigrams": _tfidf_q(WORKED_V.with_(max_ngram=3)),
    "ngrams_llr": q_ngrams_llr,
    "distance_sq_euclidean": _distance_q("sq_euclidean"),
    "distance_cosine": _distance_q("cosine"),
    "distance_euclidean": _distance_q("euclidean"),
    "distance_chebyshev": _distance_q("chebyshev"),
    "random_seeds": q_random_seeds,
    "assign_sparse": q_assign_sparse,
    "update_centroids": q_update_centroids,
    "assign_dense": q_assign_dense,
    "kmeans_dense_3iter": q_kmeans_dense_3iter,
    "kmeans_sparse_3iter": q_kmeans_sparse_3iter,
    "kmeans_worked": q_kmeans_worked,
    "kmeans_worked_long": q_kmeans_worked_long,
    "cap_points": q_cap_points,
    "top_terms": q_top_terms,
    "members": q_members,
    "cluster_sizes": q_cluster_sizes,
    "intra_stats": q_intra_stats,
    "intra_stats_capped": q_intra_stats_capped,
    "intra_avg_full": q_intra_avg_full,
    "intra_stats_full": q_intra_stats_full,
    "intra_avg_full_manhattan": q_intra_avg_full_manhattan,
    "intra_avg_full_sparse": q_intra_avg_full_sparse,
    "kmeans_dense_manhattan": q_kmeans_dense_manhattan,
    "inter_pairs": q_inter_pairs,
    "inter_stats": q_inter_stats,
    "evaluate_report": q_evaluate_report,
    "intra_stats_sparse": q_intra_stats_sparse,
    "inter_pairs_sparse": q_inter_pairs_sparse,
    "inter_stats_sparse": q_inter_stats_sparse,
    "report_text": _report_q("text"),
    "report_csv": _report_q("csv"),
    "report_graph_nodes": _report_q("nodes"),
    "report_graph_edges": _report_q("edges"),
    "report_json": _report_q("json"),
    "report_text_empty_cluster": _report_q("text", True),
    "report_csv_empty_cluster": _report_q("csv", True),
    "report_graph_nodes_empty_cluster": _report_q("nodes", True),
    "report_json_empty_cluster": _report_q("json", True),
    "report_text_substring": _report_q("text", cfg=DUMP.with_(substring=SUBSTRING)),
    "report_graph_nodes_substring": _report_q("nodes", cfg=DUMP.with_(substring=SUBSTRING)),
    "tag_lines_text": q_tag_lines_text,
    "stage_tagdocs": q_stage_tagdocs,
    "stage_vectors": q_stage_vectors,
    "stage_seeds": q_stage_seeds,
    "stage_final_clusters": q_stage_final_clusters,
    "dictionary_text": q_dictionary_text,
    "dictionary_parquet": q_dictionary_parquet,
    "kmeans_threshold": q_kmeans_threshold,
    "dump_points": q_dump_points,
    "estimate_t": q_estimate_t,
    "canopy_centers": q_canopy_centers,
    "estimate_t_sparse": q_estimate_t_sparse,
    "canopy_centers_sparse": q_canopy_centers_sparse,
    "kmeans_canopy_sparse": q_kmeans_canopy_sparse,
    "kmeans_canopy": q_kmeans_canopy,
}


def _shipped(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        ship_package(spark)   # pandas UDF workers import canopus, whatever their cwd
        return fn(spark, sf)
    run.__name__ = fn.__name__
    return run


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: TF-IDF vectors of the documents table (worked-example parameters)."""
    return _shipped(QUERIES["tfidf"])(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = dict(QUERIES)
    if llm_queries:
        found |= llm_queries.QUERIES
    if corpus_pipeline:
        found["pipeline"] = corpus_pipeline.run
    return {k: _shipped(v) for k, v in found.items()}


def oracle_sql() -> dict[str, str]:
    q = O.all_queries(DEFAULT_V=DEFAULT_V, WORKED_V=WORKED_V, STOP_V=STOP_V, SIGMA_V=SIGMA_V,
                      KM_DEFAULT=KM_DEFAULT, KM_WORKED=KM_WORKED, KM_DENSE=KM_DENSE, DUMP=DUMP,
                      CAP=CAP, EVAL_CAP=EVAL_CAP, EMPTY_WEIGHT=EMPTY_WEIGHT, SUBSTRING=SUBSTRING, THRESHOLD=THRESHOLD)
    q |= O.canopy_queries(WORKED_V, KM_DENSE, KM_SPARSE_CANOPY)
    q["estimate_t_sparse"] = O.estimate_t_sparse_sql(WORKED_V, KM_SPARSE_CANOPY)
    q["job_vectorize"], q["job_cluster"] = q["tfidf"], q["kmeans_worked"]   # the same through folders
    q["job_dump"] = q["job_report"] = f"SELECT line FROM ({q['report_csv']})"
    q["kmeans_worked_long"] = q["kmeans_worked"]   # same semantics, other physical assignment
    if llm_queries:
        q |= llm_queries.ORACLE_SQL
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        q["pipeline"] = corpus_pipeline.ORACLE_SQL
    return q
