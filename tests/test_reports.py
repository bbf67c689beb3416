"""Report writers, format dispatch and the stage pipeline."""

import glob
import os
import tempfile
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from canopus.config import DumpConfig, KMeansConfig, VectorizeConfig
from canopus.operators.topk import cap_points, member_lines
from canopus.plans import reports as rp
from canopus.plans.pipeline import run
from canopus.sources.stages import read_dictionary, read_stage, write_dictionary_text


def _points(spark):
    rows = [(c, f"d{i:03d}", 1.0, float(i) / 10) for i in range(25) for c in [i % 3]]
    return spark.createDataFrame(rows, "cluster_id int, doc_id string, weight double, distance double")


def _terms(spark):
    return spark.createDataFrame([(c, r, r, f"term<{c}&{r}>", 1.0 / r) for c in range(3) for r in (1, 2)],
                                 "cluster_id int, rank int, term_id int, term string, weight double")


def _read(path):
    out = []
    for f in sorted(glob.glob(os.path.join(path, "part-*"))):
        with open(f, encoding="utf-8") as fh:
            out += fh.read().splitlines()
    return out


def test_member_lines_are_chunked(spark):
    lines = member_lines(_points(spark), 3).orderBy("cluster_id", "chunk").collect()
    c0 = [r["members"] for r in lines if r["cluster_id"] == 0]
    assert c0[0] == "d000,d003,d006" and all(len(m.split(",")) <= 3 for m in c0)
    assert ",".join(c0).split(",") == [f"d{i:03d}" for i in range(0, 25, 3)]


def test_cap_points(spark):
    got = cap_points(_points(spark), 2).groupBy("cluster_id").count().collect()
    assert {r["count"] for r in got} == {2}


def test_all_formats_write(spark):
    out = tempfile.mkdtemp(prefix="canopus-rep-")
    pts, terms = _points(spark), _terms(spark)
    cfg = DumpConfig(line_points=4)
    for fmt in rp.FORMATS:
        rp.dump_clusters(fmt, f"{out}/{fmt}", pts, terms, cfg)
    text = _read(f"{out}/TEXT")
    assert text[0] == "VL-0{n=9}" and text[1] == "\tTop Terms:" and text[2].startswith("\t\tterm<0&1> => 1.000000")
    csv = _read(f"{out}/CSV")
    assert csv[0] == "0,d000,d003,d006,d009" and len(csv) == 7  # 9, 8, 8 members in lines of 4
    root = ET.fromstring("\n".join(_read(f"{out}/GRAPH_ML")))
    ns = "{http://graphml.graphdrawing.org/xmlns}"
    assert len(root.findall(f"{ns}graph/{ns}node")) == 28 and len(root.findall(f"{ns}graph/{ns}edge")) == 25
    js = spark.read.json(f"{out}/JSON")
    assert js.where("kind = 'point'").count() == 25 and js.where("kind = 'term'").count() == 6
    with pytest.raises(ValueError):
        rp.dump_clusters("XML", f"{out}/x", pts, terms, cfg)


def test_substring_truncates_labels(spark):
    rows = rp.report_text(_terms(spark), _points(spark), _points(spark).groupBy("cluster_id").agg(F.count("*").alias("n")),
                          DumpConfig(substring=3))
    lines = [r["line"] for r in rows.where("section = 1 AND seq = 1").collect()]
    assert all(line.startswith("\t\tter =>") for line in lines)


def test_dictionary_formats(spark):
    out = tempfile.mkdtemp(prefix="canopus-dict-")
    d = spark.createDataFrame([(0, "a"), (1, "b c")], "term_id int, term string")
    write_dictionary_text(d, f"{out}/dict")
    assert sorted(tuple(r) for r in read_dictionary(spark, f"{out}/dict", "text").collect()) == [(0, "a"), (1, "b c")]
    with pytest.raises(ValueError):
        read_dictionary(spark, f"{out}/dict", "csv")


def test_pipeline_end_to_end(spark):
    from tests_support import documents_lines
    out, rep = tempfile.mkdtemp(prefix="canopus-job-"), tempfile.mkdtemp(prefix="canopus-out-")
    lines = documents_lines(spark)
    res = run(spark, "all", lines, out, rep, VectorizeConfig(min_support=5, min_df=3, max_df_percent=50),
              KMeansConfig(k=3, max_iter=2, measure="cosine"), DumpConfig(top_n=5))
    assert res.iterations >= 1
    assert read_stage(spark, out, "points").count() == read_stage(spark, out, "tfidf").select("doc_id").distinct().count()
    text = _read(f"{rep}/clusters_dump")
    assert text[0].startswith("VL-0{n=")
    assert len(_read(f"{rep}/cluster_points_dump")) == read_stage(spark, out, "points").count()


def test_pipeline_canopy_seeded_with_evaluation(spark):
    from tests_support import documents_lines
    out, rep = tempfile.mkdtemp(prefix="canopus-job-"), tempfile.mkdtemp(prefix="canopus-out-")
    lines = documents_lines(spark)
    res = run(spark, "all", lines, out, rep, VectorizeConfig(min_support=5, min_df=3, max_df_percent=50),
              KMeansConfig(max_iter=2, init="canopy"), DumpConfig(top_n=5, evaluate=True))
    k = read_stage(spark, out, "clusters").select("cluster_id").distinct().count()
    assert k >= 2 and res.points.select("cluster_id").distinct().count() <= k
    ev_lines = _read(f"{rep}/cluster_evaluate_result")
    assert any(line.startswith("Scaled Inter-Cluster Density") for line in ev_lines)
