"""k-means invariants and sparse assignment (FIXTURES H7)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from canopus.config import KMeansConfig
from canopus.operators import kmeans as km
from canopus.sources.points import gaussian_points


def _sparse(spark, rows):
    return spark.createDataFrame(rows, "doc_id string, term_id int, weight double")


def test_h7_doc_without_shared_terms_is_assigned(spark):
    pts = _sparse(spark, [("a", 0, 1.0), ("b", 1, 1.0), ("z", 9, 2.0)])
    cent = spark.createDataFrame([(0, 0, 1.0), (1, 1, 3.0)], "cluster_id int, term_id int, weight double")
    rows = km.assign_sparse_rows(km.prepare_sparse_points(pts, 2), cent, 2, [1.0, 9.0], "sq_euclidean")
    got = {r["doc_id"]: (r["cluster_id"], r["distance"]) for r in rows.where("_first").collect()}
    assert got["z"] == (0, 5.0)          # 4 + 1, nothing shared
    assert got["a"] == (0, 0.0) and got["b"] == (0, 2.0)   # 1 + 1 - 0 beats 1 + 9 - 6


def test_cosine_zero_vector_rules(spark):
    from canopus.functions.distance import distance
    df = spark.createDataFrame([([0.0, 0.0], [0.0, 0.0]), ([0.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [2.0, 0.0])],
                               "a array<double>, b array<double>")
    got = [r["d"] for r in df.select(distance("cosine").dense(F.col("a"), F.col("b")).alias("d")).collect()]
    assert got == [0.0, 1.0, 0.0]


def test_seeds_are_points_and_deterministic(spark):
    ids = spark.range(100).select(F.col("id").cast("string").alias("doc_id"))
    a = km.random_seeds(ids, 5, 7).collect()
    b = km.random_seeds(ids.repartition(3), 5, 7).collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]
    assert [r["cluster_id"] for r in a] == list(range(5))


def test_dense_kmeans_finds_gaussian_blobs(spark):
    blobs = [gaussian_points(spark, 60, mx, my, 0.3, seed=s, num_partitions=2)
             .select((F.col("point_id") + off).alias("point_id"), "vec")
             for s, (mx, my, off) in enumerate([(0, 0, 0), (10, 10, 1000), (-10, 10, 2000)])]
    pts = blobs[0].unionByName(blobs[1]).unionByName(blobs[2])
    seeds = [r["vec"] for r in pts.where("point_id IN (0, 1000, 2000)").orderBy("point_id").collect()]   # one of each blob
    res = km.kmeans_dense(pts, seeds, KMeansConfig(k=3, max_iter=10, delta=1e-9))
    groups = res.points.select("cluster_id", (F.col("point_id") / 1000).cast("int").alias("blob")).distinct()
    assert sorted(tuple(r) for r in groups.collect()) == [(0, 0), (1, 1), (2, 2)]
    assert {(r["cluster_id"], r["n"]) for r in res.centers.collect()} == {(0, 60), (1, 60), (2, 60)}
    assert res.converged and res.points.count() == 180
    assert km.kmeans_dense_random(pts, KMeansConfig(k=3)).points.count() == 180
    assert res.points.select("point_id").distinct().count() == 180


def _objective(points_df):
    return points_df.agg(F.sum("distance")).first()[0]


def test_sparse_objective_never_increases(spark):
    rng = np.random.default_rng(3)
    rows = [(f"d{i}", int(t), float(rng.random() + 0.1)) for i in range(60)
            for t in rng.choice(30, size=6, replace=False)]
    vecs = _sparse(spark, rows)
    objs = []
    for it in (1, 2, 3, 4):
        res = km.kmeans_sparse_random(vecs, KMeansConfig(k=4, max_iter=it, delta=-1.0))
        objs.append(_objective(res.points))
    assert all(b <= a + 1e-9 for a, b in zip(objs, objs[1:]))


def test_sparse_same_result_any_partitioning(spark):
    rng = np.random.default_rng(5)
    rows = [(f"d{i}", int(t), float(rng.random())) for i in range(40) for t in rng.choice(20, size=5, replace=False)]
    vecs = _sparse(spark, rows)
    cfg = KMeansConfig(k=3, max_iter=3)
    a = km.kmeans_sparse(km.prepare_sparse_points(vecs, 2),
                         km.seed_centroids_sparse(vecs, km.random_seeds(vecs.select("doc_id").distinct(), 3, 1)), 3, cfg,
                         prepared=True)
    b = km.kmeans_sparse(km.prepare_sparse_points(vecs, 5),
                         km.seed_centroids_sparse(vecs, km.random_seeds(vecs.select("doc_id").distinct(), 3, 1)), 3, cfg,
                         prepared=True)
    key = lambda df: sorted((r["doc_id"], r["cluster_id"]) for r in df.collect())
    assert key(a.points) == key(b.points)


def test_empty_cluster_keeps_centre(spark):
    vecs = _sparse(spark, [("a", 0, 1.0), ("b", 0, 1.1)])
    seeds = spark.createDataFrame([(0, 0, 1.0), (1, 5, 100.0)], "cluster_id int, term_id int, weight double")
    res = km.kmeans_sparse(vecs, seeds, 2, KMeansConfig(k=2, max_iter=2))
    c1 = [(r["term_id"], r["weight"]) for r in res.centers.where("cluster_id = 1").collect()]
    assert c1 == [(5, 100.0)]


def test_unknown_measure(spark):
    from canopus.functions.distance import distance
    with pytest.raises(ValueError):
        distance("nope")


@pytest.mark.parametrize("measure", ["sq_euclidean", "cosine"])
def test_long_form_assignment_equals_array_form(spark, measure, monkeypatch):
    import numpy as np
    from canopus.operators import kmeans as km
    rng = np.random.default_rng(5)
    rows = [(f"d{i:03d}", int(t), float(rng.integers(1, 4))) for i in range(80)
            for t in rng.choice(30, size=int(rng.integers(1, 5)), replace=False)]
    pts = spark.createDataFrame(rows, "doc_id string, term_id int, weight double")
    # 12 centres, several sharing no term with many documents, two with equal norms
    cent_rows = [(c, int(t), 1.0) for c in range(12) for t in ([30 + c] if c in (3, 7) else rng.choice(30, size=3, replace=False))]
    cent = spark.createDataFrame(cent_rows, "cluster_id int, term_id int, weight double")
    c2 = [sum(w * w for c, _, w in cent_rows if c == j) for j in range(12)]
    a = km.assign_sparse_rows(pts, cent, 12, c2, measure).where("_first").select("doc_id", "cluster_id", "distance")
    for block in (km.CENTER_BLOCK_VALUES, 8):
        monkeypatch.setattr(km, "CENTER_BLOCK_VALUES", block)
        b = km.nearest_center_rows(pts, cent, 12, c2, measure, len(cent_rows))
        assert sorted(a.collect()) == sorted(b.collect())


@pytest.mark.parametrize("measure", ["sq_euclidean", "cosine", "manhattan"])
def test_dense_batch_assignment_equals_expressions(spark, measure, monkeypatch):
    from canopus.operators import kmeans as km
    rng = np.random.default_rng(9)
    pts = spark.createDataFrame([(i, [float(x) for x in rng.integers(0, 4, size=5)]) for i in range(120)],
                                "point_id long, vec array<double>")
    centers = [[float(x) for x in rng.integers(0, 4, size=5)] for _ in range(6)] + [[1.0] * 5, [1.0] * 5]
    a = km.assign_dense(pts, centers, measure).select("point_id", "cluster_id", "distance")
    for block in (km.DENSE_BLOCK_VALUES, 10):
        monkeypatch.setattr(km, "DENSE_BLOCK_VALUES", block)
        b = km.assign_dense(pts, centers, measure, max_k_expr=0).select("point_id", "cluster_id", "distance")
        assert sorted(a.collect()) == sorted(b.collect())


def test_many_dense_centers_plan_quickly(spark):
    import time
    from canopus.operators import evaluate as ev
    from canopus.operators import kmeans as km
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(32, 1024)).tolist()
    pts = spark.createDataFrame([(i, c) for i, c in enumerate(centers)], "point_id long, vec array<double>")
    t = time.time()
    got = km.assign_dense(pts, centers, "sq_euclidean")
    pairs = ev.inter_pairs(pts.select(F.col("point_id").cast("int").alias("cluster_id"), F.col("vec").alias("center")))
    got._jdf.queryExecution().executedPlan(), pairs._jdf.queryExecution().executedPlan()
    assert time.time() - t < 10
    assert [r["cluster_id"] for r in got.orderBy("point_id").collect()] == list(range(32))
    assert pairs.count() == 32 * 31 // 2
    big = km.assign_dense(pts.limit(3), centers * 64, "sq_euclidean")   # 2,097,152 values
    assert big.count() == 3


def test_custom_measure_runs_both_forms(spark):
    from canopus.config import KMeansConfig
    from canopus.functions.distance import distance, register_distance
    from canopus.operators import kmeans as km
    sq = distance("sq_euclidean")
    register_distance("halved", lambda x, c: sq.dense(x, c) / 2, lambda x2, c2, dot: sq.sparse(x2, c2, dot) / 2)
    pts = spark.createDataFrame([(i, [float(i % 2) * 9, float(i)]) for i in range(20)], "point_id long, vec array<double>")
    a = km.kmeans_dense_random(pts, KMeansConfig(k=2, measure="halved", max_iter=4))
    b = km.kmeans_dense_random(pts, KMeansConfig(k=2, max_iter=4, delta=0.02))
    assert {r["point_id"]: r["cluster_id"] for r in a.points.collect()} == {r["point_id"]: r["cluster_id"] for r in b.points.collect()}
    vecs = spark.createDataFrame([(f"d{i}", t, 1.0 + i % 3) for i in range(12) for t in range(i % 2, 6, 2)], "doc_id string, term_id int, weight double")
    s = km.kmeans_sparse_random(vecs, KMeansConfig(k=2, measure="halved", max_iter=3, array_max_k=0))
    assert s.points.count() == 12 and len(s.shifts[0]) == 2


@pytest.mark.parametrize("measure", ["sq_euclidean", "manhattan"])
def test_centers_as_a_table_give_the_same_clusters(spark, measure, monkeypatch):
    """More centres than the literal path takes, in one tile and in many; empty clusters stay."""
    from canopus.config import KMeansConfig
    from canopus.operators import blocks, kmeans as km
    rng = np.random.default_rng(4)
    x = rng.integers(0, 9, size=(300, 4)).astype(float)
    centers = rng.integers(0, 9, size=(40, 4)).astype(float).tolist() + [[99.0] * 4]
    pts = spark.createDataFrame([(f"p{i}", v.tolist()) for i, v in enumerate(x)], "point_id string, vec array<double>")
    cfg = KMeansConfig(max_iter=2, measure=measure, delta=0.0)
    want = km.kmeans_dense(pts, centers, cfg.with_(array_max_k=64))   # expressions
    picked = {r["point_id"]: (r["cluster_id"], round(r["distance"], 6)) for r in want.points.collect()}
    cents = {r["cluster_id"]: (r["n"], r["center"]) for r in want.centers.collect()}
    assert cents[40] == (0, [99.0] * 4)
    for values in (blocks.TILE_VALUES, 30):
        monkeypatch.setattr(blocks.tiles, "__defaults__", (values,))
        monkeypatch.setattr(blocks.pack, "__defaults__", (False, 7, blocks.PACK_VALUES, None))
        got = km.kmeans_dense(pts, centers, cfg)
        assert {r["point_id"]: (r["cluster_id"], round(r["distance"], 6)) for r in got.points.collect()} == picked
        back = {r["cluster_id"]: (r["n"], r["center"]) for r in got.centers.collect()}
        assert back.keys() == cents.keys() and all(back[c][0] == cents[c][0] and np.allclose(back[c][1], cents[c][1]) for c in cents)
        assert got.iterations == want.iterations and len(got.shifts[0]) == 1


def test_custom_measure_with_many_centers_plans_quickly(spark):
    import time
    from canopus.config import KMeansConfig
    from canopus.functions.distance import distance, register_distance
    from canopus.operators import kmeans as km
    register_distance("thirds", lambda x, c: distance("sq_euclidean").dense(x, c) / 3)
    rng = np.random.default_rng(6)
    centers = rng.normal(size=(1000, 64)).tolist()
    pts = spark.createDataFrame([(i, c) for i, c in enumerate(centers[:200])], "point_id long, vec array<double>")
    table = spark.createDataFrame([(j, c) for j, c in enumerate(centers)], "cluster_id int, center array<double>")
    table.count()
    t = time.time()
    got = km.assign_dense_structs(pts, table, "thirds")
    got._jdf.queryExecution().executedPlan()
    assert time.time() - t < 5
    assert all(r["cluster_id"] == r["point_id"] and r["distance"] == 0 for r in got.collect())
    res = km.kmeans_dense(pts, centers, KMeansConfig(max_iter=1, measure="thirds"))
    assert res.points.where("cluster_id = point_id").count() == 200 and res.centers.count() == 1000


@pytest.mark.parametrize("measure", ["sq_euclidean", "cosine"])
def test_centres_too_large_for_a_broadcast_leave_points_in_place(spark, measure, monkeypatch):
    """No point is shuffled, however many entries the centres have; runs and blocks change nothing."""
    rng = np.random.default_rng(11)
    rows = [(f"d{i:03d}", int(t), float(rng.integers(1, 9))) for i in range(120) for t in rng.choice(40, size=int(rng.integers(1, 9)), replace=False)]
    pts = km.prepare_sparse_points(_sparse(spark, rows), 3)
    seeds = km.seed_centroids_sparse(pts, km.random_seeds(pts.select("doc_id").distinct(), 4, 1))
    cfg = KMeansConfig(k=4, max_iter=3, delta=-1.0, measure=measure, broadcast_max_values=0)

    def clusters():
        res = km.kmeans_sparse(pts, seeds, 4, cfg, prepared=True)
        cent = {(r["cluster_id"], r["term_id"]): r["weight"] for r in res.centers.collect()}
        return sorted((r["doc_id"], r["cluster_id"], round(r["distance"], 6)) for r in res.points.collect()), cent

    want, cents = clusters()
    st = km.sparse_center_stats(seeds, seeds)
    packed = km.cut_lineage(km.packed_documents(pts))
    blocks = km.center_postings(seeds, 4, [st[j]["n2"] for j in range(4)], sum(s["nnz"] for s in st.values()))
    assert "Exchange" not in km.past_blocks(packed, blocks, measure, sums=True)._jdf.queryExecution().executedPlan().toString()
    rows_of = km.assign_sparse_rows(pts, seeds, 4, [st[j]["n2"] for j in range(4)], measure)
    old = {(r["cluster_id"], r["term_id"]): (round(r["s"], 6), r["f"]) for r in km.centroid_sums(rows_of).collect()}
    for name, value in (("CENTER_BLOCK_VALUES", 8), ("CENTER_BLOCKS", 1), ("BATCH_ENTRIES", 5), ("BATCH_POSTINGS", 3), ("SUM_ENTRIES", 4)):
        monkeypatch.setattr(km, name, value)
    blocks = km.center_postings(seeds, 4, [st[j]["n2"] for j in range(4)], sum(s["nnz"] for s in st.values()))
    assert len(blocks) > 1
    parts = km.past_blocks(packed, blocks, measure, sums=True).groupBy("cluster_id", "term_id").agg(F.sum("s").alias("s"), F.sum("f").alias("f"))
    assert {(r["cluster_id"], r["term_id"]): (round(r["s"], 6), r["f"]) for r in parts.collect()} == old
    got, again = clusters()
    assert got == want and again.keys() == cents.keys() and all(abs(again[k] - cents[k]) < 1e-9 for k in cents)


def test_points_are_packed_before_they_are_shuffled(spark):
    """Documents cut by batches and partitions are put together; whole ones are one shuffled row."""
    rows = [(f"d{i:02d}" if i else None, t, float(t % 3 + 1)) for i in range(9) for t in range(1 + 2 * i)] + [("d03", 1, 0.5)]
    vecs = _sparse(spark, rows)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for batch, n in ((old, 1), ("4", 3)):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            packed = km.packed_points(vecs.coalesce(1) if n == 1 else vecs.repartition(n), n)
            got = {r["doc_id"]: (r["idx"], r["val"]) for r in packed.collect()}
            assert len(got) == packed.count() == 9 and got["d03"][0] == [0, 1, 1, 2, 3, 4, 5, 6]
            assert all(i == sorted(i) for i, _ in got.values())
            assert sorted(map(str, km.long_form(packed).collect())) == sorted(map(str, vecs.collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    plan = km.packed_rows(vecs)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("hashpartitioning(doc_id") < plan.index("MapInArrow")   # the exchange is above
    seeds = km.random_seeds(packed.select("doc_id"), 2, 1)
    assert sorted(km.seed_centroids_sparse(packed, seeds).collect()) == sorted(km.seed_centroids_sparse(vecs, seeds).collect())


def test_centres_with_most_terms_are_a_matrix(spark, monkeypatch):
    """The same nearest centres and sums by a matrix as by postings, for documents without terms of a block too."""
    rng = np.random.default_rng(5)
    rows = [(f"d{i:03d}", int(t), float(rng.integers(1, 9))) for i in range(60) for t in rng.choice(30, size=int(rng.integers(1, 12)), replace=False)]
    packed = km.cut_lineage(km.packed_documents(_sparse(spark, rows)))
    cent = spark.createDataFrame([(j, t, float(j + t % 3 + 1)) for j in range(3) for t in range(2, 22) if (t + j) % 5], "cluster_id int, term_id int, weight double")
    st = km.sparse_center_stats(cent, cent)
    got = []
    for share in (3, 0):
        monkeypatch.setattr(km, "DENSE_SHARE", share)
        blocks = km.center_postings(cent, 3, [st[j]["n2"] for j in range(3)], sum(s["nnz"] for s in st.values()))
        assert [b.value[3] is None for b in blocks] == [share == 3]
        near = km.past_blocks(packed, blocks, "cosine").select("doc_id", "cluster_id", "distance")
        sums = km.past_blocks(packed, blocks, "cosine", sums=True).groupBy("cluster_id", "term_id").agg(F.sum("s"), F.sum("f"))
        got.append([sorted(map(tuple, x.collect())) for x in (near, sums)])
    assert got[0] == got[1] and len(got[0][0]) == 60


@pytest.mark.parametrize("measure", ["sq_euclidean", "cosine"])
def test_packed_points_are_assigned_without_a_shuffle(spark, measure):
    """Rows and means as from points in long form; no window over a document's rows."""
    rng = np.random.default_rng(5)
    rows = [(f"d{d}", int(t), float(rng.random() + 0.1)) for d in range(60) for t in sorted(rng.choice(30, 1 + d % 7, replace=False))] + [(None, 3, 1.0), ("far", 99, 2.0)]
    pts = _sparse(spark, rows)
    packed = km.packed_points(pts, 3)
    seeds = km.seed_centroids_sparse(packed, km.random_seeds(packed.select("doc_id"), 4, 1, "doc_id"))
    st = km.sparse_center_stats(seeds, seeds)
    c2 = [st[j]["n2"] for j in range(4)]
    old, new = (km.assign_sparse_rows(p, seeds, 4, c2, measure) for p in (pts, packed))
    key = lambda df: sorted((str(r["doc_id"]), r["term_id"], r["weight"], r["_first"], r["cluster_id"], round(r["distance"], 8)) for r in df.collect())
    assert key(new) == key(old) and len(key(new)) == len(rows)
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan
    means = [sorted((r["cluster_id"], r["term_id"], round(r["weight"], 9)) for r in km.update_sparse(x, seeds).collect()) for x in (old, new)]
    assert means[0] == means[1]
