"""Evaluation (FIXTURES H4, H6) and the tiled pair computation against brute force."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from canopus.operators import evaluate as ev


def _pts(spark, rows):
    return spark.createDataFrame([(c, i, [float(x)]) for c, i, x in rows], "cluster_id int, point_id long, vec array<double>")


def test_h4_intra(spark):
    pts = _pts(spark, [(0, 1, 0), (0, 2, 1), (0, 3, 3), (1, 4, 10), (1, 5, 12), (2, 6, 20)])
    got = {r["cluster_id"]: r for r in ev.intra_stats(pts, "sq_euclidean", 1000).collect()}
    c0 = got[0]
    assert (c0["n_used"], c0["n_pairs"]) == (3, 3)
    assert c0["avg_dist"] == pytest.approx(14 / 3) and c0["min_dist"] == 1 and c0["max_dist"] == 9
    assert c0["density"] == pytest.approx((14 / 3 - 1) / 8)
    assert got[1]["avg_dist"] == 4 and got[1]["density"] is None
    assert got[2]["n_pairs"] == 0 and got[2]["avg_dist"] is None and got[2]["min_dist"] is None


def test_h4_inter(spark):
    cents = spark.createDataFrame([(0, [0.0]), (1, [1.0]), (2, [3.0])], "cluster_id int, center array<double>")
    pairs = ev.inter_pairs(cents)
    assert sorted((r["cluster_id_1"], r["cluster_id_2"], r["distance"]) for r in pairs.collect()) == [
        (0, 1, 1.0), (0, 2, 9.0), (1, 2, 4.0)]
    s = ev.inter_stats(pairs).first()
    assert s["avg_dist"] == pytest.approx(14 / 3) and s["density"] == pytest.approx((14 / 3 - 1) / 8)
    one = ev.inter_stats(ev.inter_pairs(cents.where("cluster_id = 0"))).first()
    assert one["n_pairs"] == 0 and one["max_dist"] is None and one["density"] is None


def test_h6_pairs_are_unordered(spark):
    cents = spark.createDataFrame([(22, [1.0]), (11, [0.0]), (33, [5.0])], "cluster_id int, center array<double>")
    keys = sorted((r["cluster_id_1"], r["cluster_id_2"]) for r in ev.inter_pairs(cents).collect())
    assert keys == [(11, 22), (11, 33), (22, 33)]


@pytest.mark.parametrize("cap,block", [(None, 3), (7, 2), (1000, 256)])   # None: closed form
def test_tiles_match_brute_force(spark, cap, block):
    rng = np.random.default_rng(11)
    rows = [(int(c), int(i), rng.normal(size=3).tolist()) for i, c in enumerate(rng.integers(0, 3, size=40))]
    df = spark.createDataFrame(rows, "cluster_id int, point_id long, vec array<double>")
    got = {r["cluster_id"]: r for r in ev.intra_stats(df, "sq_euclidean", cap, block=block).collect()}
    for c in range(3):
        vs = [np.array(v) for cc, i, v in sorted(rows, key=lambda r: r[1]) if cc == c]
        if cap is not None:
            vs = vs[:cap]
        d = [float(((a - b) ** 2).sum()) for a, b in itertools.combinations(vs, 2)]
        assert got[c]["n_pairs"] == len(d)
        assert got[c]["avg_dist"] == pytest.approx(sum(d) / len(d))
        assert (got[c]["n_total"], got[c]["n_used"]) == (sum(cc == c for cc, _, _ in rows), len(vs))
        if cap is None:
            assert got[c]["min_dist"] is None and got[c]["max_dist"] is None and got[c]["density"] is None
        else:
            assert got[c]["min_dist"] == pytest.approx(min(d)) and got[c]["max_dist"] == pytest.approx(max(d))


def test_closed_form_cosine_with_zero_vectors(spark):
    vs = [[1.0, 0.0], [0.0, 2.0], [0.0, 0.0], [0.0, 0.0], [3.0, 3.0]]
    df = spark.createDataFrame([(0, i, v) for i, v in enumerate(vs)], "cluster_id int, point_id long, vec array<double>")
    exact = ev.intra_stats(df, "cosine", 100).first()
    assert ev.intra_stats(df, "cosine").first()["avg_dist"] == pytest.approx(exact["avg_dist"])
    long = spark.createDataFrame([(i, t, w) for i, v in enumerate(vs) for t, w in enumerate(v) if w], "doc_id long, term_id int, weight double")
    pts = df.select("cluster_id", F.col("point_id").alias("doc_id"))
    assert ev.intra_stats_sparse(pts, long, "cosine").first()["avg_dist"] == pytest.approx(exact["avg_dist"])


def test_report_lines(spark):
    pts = _pts(spark, [(0, 1, 0), (0, 2, 1), (1, 3, 5)])
    cents = spark.createDataFrame([(0, [0.5]), (1, [5.0])], "cluster_id int, center array<double>")
    pairs = ev.inter_pairs(cents)
    rep = ev.evaluation_report(ev.intra_stats(pts), ev.inter_stats(pairs), pairs)
    lines = [r["line"] for r in rep.orderBy("section", "key1", "key2").collect()]
    assert lines[0] == "Cluster intra info :"
    assert lines[1] == "ClusterID : 0 Intra Average Distance : 1.000000 Intra Density : NaN"
    assert "Scaled Inter-Cluster Density: NaN" in lines
    assert lines[-1] == "The distance between cluster : 0 and cluster : 1 is 20.250000"


@pytest.mark.parametrize("measure", ["sq_euclidean", "cosine"])
def test_sparse_intra_and_inter_match_dense(spark, measure):
    rng = np.random.default_rng(2)
    docs = {f"d{i:02d}": {int(t): float(rng.random() + 0.1) for t in rng.choice(12, size=4, replace=False)}
            for i in range(30)}
    clusters = {d: int(rng.integers(0, 3)) for d in docs}
    long = spark.createDataFrame([(d, t, w) for d, m in docs.items() for t, w in m.items()],
                                 "doc_id string, term_id int, weight double")
    pts = spark.createDataFrame(list(clusters.items()), "doc_id string, cluster_id int")
    dense = spark.createDataFrame([(clusters[d], d, [m.get(t, 0.0) for t in range(12)]) for d, m in docs.items()],
                                  "cluster_id int, doc_id string, vec array<double>")
    a = {r["cluster_id"]: r for r in ev.intra_stats_sparse(pts, long, measure, 7, block=3).collect()}
    b = {r["cluster_id"]: r for r in ev.intra_stats(dense, measure, 7, id_col="doc_id", block=4).collect()}
    for c in b:
        assert a[c]["n_pairs"] == b[c]["n_pairs"]
        for k in ("avg_dist", "min_dist", "max_dist"):
            assert a[c][k] == pytest.approx(b[c][k], abs=1e-9)
    cl = spark.createDataFrame([(c, int(t), float(rng.random())) for c in range(4) for t in rng.choice(12, 5, replace=False)],
                               "cluster_id int, term_id int, weight double")
    cd = cl.groupBy("cluster_id").agg(F.map_from_entries(F.collect_list(F.struct("term_id", "weight"))).alias("m")).select(
        "cluster_id", F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: F.coalesce(F.element_at("m", i), F.lit(0.0)))
        .alias("center"))
    ps = {(r[0], r[1]): r[2] for r in ev.inter_pairs_sparse(cl, measure).collect()}
    pdn = {(r[0], r[1]): r[2] for r in ev.inter_pairs(cd, measure).collect()}
    assert ps.keys() == pdn.keys() and all(ps[k] == pytest.approx(pdn[k], abs=1e-9) for k in ps)


@pytest.mark.parametrize("measure", ["sq_euclidean", "cosine", "manhattan"])
def test_inter_statistics_need_no_pair_rows(spark, measure, monkeypatch):
    from canopus.operators import blocks
    rng = np.random.default_rng(7)
    c = rng.normal(size=(25, 3))
    cents = spark.createDataFrame([(3 * i, v.tolist()) for i, v in enumerate(c)], "cluster_id int, center array<double>")
    want = ev.inter_stats(ev.inter_pairs(cents, measure)).first()
    assert want["n_pairs"] == 300
    monkeypatch.setattr(blocks.tiles, "__defaults__", (20,))
    monkeypatch.setattr(blocks.pack, "__defaults__", (False, 4, blocks.PACK_VALUES, None))
    assert ev.inter_pairs(cents, measure).distinct().count() == 300
    got = ev.inter_stats_of_centers(cents, measure).first()
    assert got["n_pairs"] == 300 and all(got[k] == pytest.approx(want[k]) for k in ("max_dist", "min_dist", "avg_dist", "density"))
    one = ev.inter_stats_of_centers(cents.where("cluster_id = 0"), measure).first()
    assert one["n_pairs"] == 0 and one["max_dist"] is None and one["avg_dist"] is None and one["density"] is None


def test_manhattan_average_without_pairs(spark):
    rng = np.random.default_rng(8)
    rows = [(int(c), i, rng.integers(0, 5, 3).astype(float).tolist()) for i, c in enumerate(rng.integers(0, 3, 60))] + [(7, 99, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "cluster_id int, point_id long, vec array<double>")
    got = {r["cluster_id"]: r for r in ev.intra_stats(df, "manhattan").collect()}
    want = {r["cluster_id"]: r for r in ev.intra_stats(df, "manhattan", 1000).collect()}
    assert got.keys() == want.keys() and got[7]["avg_dist"] is None
    assert all(got[c]["avg_dist"] == pytest.approx(want[c]["avg_dist"]) and got[c]["n_pairs"] == want[c]["n_pairs"] for c in (0, 1, 2))


@pytest.mark.parametrize("measure", ["sq_euclidean", "euclidean", "manhattan", "chebyshev"])
def test_exact_extremes_open_few_tiles(spark, measure, monkeypatch):
    from canopus.operators import blocks
    monkeypatch.setattr(ev, "PACK_BITS", 4)
    rng = np.random.default_rng(13)
    blobs = rng.normal(size=(12, 3)) * 50
    x = np.concatenate([b + rng.normal(size=(40, 3)) for b in blobs])
    rows = [(i % 2, i, v.tolist()) for i, v in enumerate(x)] + [(5, 9000, [1.0, 2.0, 3.0]), (6, 9001, [0.0] * 3), (6, 9002, [0.0] * 3)]
    df = spark.createDataFrame(rows, "cluster_id int, point_id long, vec array<double>")
    want = {r["cluster_id"]: r for r in ev.intra_stats(df, measure, 10_000).collect()}
    for values in (blocks.TILE_VALUES, 600):
        monkeypatch.setattr(blocks.tiles, "__defaults__", (values,))
        got = {r["cluster_id"]: r for r in ev.intra_extremes(df, measure).collect()}
        assert got.keys() == want.keys()
        for c in want:
            assert got[c]["min_dist"] == pytest.approx(want[c]["min_dist"]) and got[c]["max_dist"] == pytest.approx(want[c]["max_dist"])
    assert got[5]["min_dist"] is None and got[6]["max_dist"] == 0
    tiles, opened = (sum(got[c][k] for c in (0, 1)) for k in ("tiles", "opened"))
    assert tiles >= 2 * 15 * 14 / 2 and opened < tiles / 2   # packs of at most 16 points
    if measure in ("sq_euclidean", "manhattan"):
        full = {r["cluster_id"]: r for r in ev.intra_stats_full(df, measure).collect()}
        assert all(full[c]["density"] == pytest.approx(want[c]["density"]) for c in (0, 1)) and full[5]["density"] is None
