"""

  BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8)
Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
Each run is forced with the ``noop`` sink (full execution, nothing collected).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
# Python workers (applyInPandas / mapInPandas) import the package too
os.environ["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, os.environ.get("PYTHONPATH")) if p)

from pyspark.sql import functions as F  # noqa: E402

from canopus.config import KMeansConfig, VectorizeConfig  # noqa: E402
from canopus.operators import canopy as cn  # noqa: E402
from canopus.operators import evaluate as ev  # noqa: E402
from canopus.operators import kmeans as km  # noqa: E402
from canopus.operators.topk import top_terms  # noqa: E402
from canopus.plans import reports as rp  # noqa: E402
from canopus.operators.topk import cluster_sizes  # noqa: E402
from canopus.operators.vectorize import vectorize  # noqa: E402
from canopus.session import build_session  # noqa: E402
from canopus.sources.points import read_embeddings  # noqa: E402
from canopus.sources.tags import documents_tag_docs  # noqa: E402

WORKED_V = VectorizeConfig(min_support=5, min_df=3, max_df_percent=50)
WORKED_K = KMeansConfig(k=4, max_iter=10, delta=0.1, measure="cosine")
DENSE_K = KMeansConfig(k=10, max_iter=3)


def run(df):
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", "canopus-bench", int(cpus), {
        "spark.driver.memory": "16g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC"})
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    warm: dict[str, float] = {}
    held: dict = {}

    def vectorise():
        st = vectorize(documents_tag_docs(spark, sf_dir, WORKED_V), WORKED_V)
        held.update(st=st, pts=km.packed_points(st.tfidf))   # materialises the TF-IDF vectors

    def kmeans_sparse():
        pts = held["pts"]
        seeds = km.random_seeds(pts.select("doc_id"), WORKED_K.k, WORKED_K.seed)
        held["res"] = km.kmeans_sparse(pts, km.seed_centroids_sparse(pts, seeds), WORKED_K.k, WORKED_K, prepared=True)
        run(held["res"].points)

    def dump_report():
        res = held["res"]
        terms = top_terms(res.centers, held["st"].dictionary, 50)
        run(rp.report_text(terms, res.points, cluster_sizes(res.points, clusters=res.centers)))

    def kmeans_dense():
        held["dres"] = km.kmeans_dense_random(emb, DENSE_K)
        run(held["dres"].points)

    def evaluate():
        lp = emb.select(F.col("label").alias("cluster_id"), "point_id", "vec")
        intra = ev.intra_stats(lp, "sq_euclidean", 1000)
        pairs = ev.inter_pairs(ev.label_centroids(emb, "label"))
        run(ev.evaluation_report(intra, ev.inter_stats(pairs), pairs))

    def canopy_dense():
        run(cn.kmeans_canopy(emb, DENSE_K)[0].points)

    emb = read_embeddings(spark, sf_dir)
    headline = (vectorise, kmeans_sparse, dump_report, kmeans_dense, evaluate)
    for f in headline:
        t = time.time()
        f()
        times[{"vectorise": "vectorize"}.get(f.__name__, f.__name__)] = time.time() - t
    for f in (canopy_dense, *headline, canopy_dense):   # the canopy path, then each once more when code is compiled
        t = time.time()
        f()
        warm[f.__name__ if f is canopy_dense and f.__name__ not in warm else f"{f.__name__}_warm"] = time.time() - t

    res, dres = held["res"], held["dres"]
    total = sum(times.values())
    print(json.dumps({"metric": "total_sec", "value": round(total, 3), "unit": "sec",
                      "queries": {k: round(v, 3) for k, v in times.items()}, "sf": sf,
                      "more": {k: round(v, 3) for k, v in warm.items()}, "iterations": {"kmeans_sparse": res.iterations, "kmeans_dense": dres.iterations}}))
    spark.stop()


if __name__ == "__main__":
    main()
