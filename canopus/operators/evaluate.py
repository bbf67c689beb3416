"""Cluster evaluation.

Intra-cluster: with ``max_points=None`` (default) the average over all pairs of a cluster
comes from a closed form for squared Euclidean (``n sum|x|^2 - |sum x|^2``), cosine (the norm
of the summed unit vectors) and Manhattan distance (per cluster and entry, ``(2i - n - 1) x``
summed over the values by rank ``i``); minimum, maximum and density, which need the pairs, are NULL
here and exact in :func:`intra_stats_full`. With an explicit ``max_points`` (the original uses 1000) the first points in
id order are compared pairwise; ``n_total`` and ``n_used`` tell how many there are and how
many were used. Pairs are never materialised as rows: each cluster's points are cut into blocks of ``block`` points, every (block_i <= block_j) tile becomes
one ``applyInPandas`` group of at most 2*block points, and each tile returns a single row
(pair count, sum, min, max). Tiles are then combined per cluster.

Inter-cluster: distances between every pair of centres (i < j), block by block, then max /
min / avg / scaled density; the statistics alone need no row per pair. Density ``(avg-min)/(max-min)`` is NULL where the original yields NaN
(0/0: one pair, equal distances, or no pairs).
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from canopus.functions.distance import distance
from canopus.operators.blocks import distances, one_pack, pack, read_block, tiles, with_tile
from canopus.operators.ranking import with_global_index
from canopus.session import cut_lineage

TILE_SCHEMA = "cluster_id int, n_pairs long, s double, mn double, mx double"
DENSE_TILE_CELLS = 32_000_000  # cells of a tile's dense matrices over all shared terms, beyond which terms go one by one
DENSE_RUN_CELLS = 4_000_000    # and of those held at once (32 MB of doubles)


def _tile_fn(measure: str):
    tile = distance(measure).tile

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        cid, lo, hi = int(pdf["cluster_id"].iat[0]), int(pdf["lo"].iat[0]), int(pdf["hi"].iat[0])
        a = pdf[pdf["blk"] == lo].sort_values("rn")
        va = np.stack(a["vec"].to_numpy()).astype(float) if len(a) else np.zeros((0, 0))
        if lo == hi:
            if len(a) < 2:
                return pd.DataFrame([(cid, 0, 0.0, None, None)], columns=["cluster_id", "n_pairs", "s", "mn", "mx"])
            d = tile(va, va)[np.triu_indices(len(a), 1)]
        else:
            b = pdf[pdf["blk"] == hi].sort_values("rn")
            vb = np.stack(b["vec"].to_numpy()).astype(float)
            d = tile(va, vb).ravel()
        return pd.DataFrame([(cid, int(d.size), float(d.sum()), float(d.min()), float(d.max()))],
                            columns=["cluster_id", "n_pairs", "s", "mn", "mx"])
    return run


INTRA_COLUMNS = ("cluster_id", "n_total", "n_used", "n_pairs", "avg_dist", "min_dist", "max_dist", "density")


def _average_only(sums: DataFrame) -> DataFrame:
    """From per-cluster ``n`` and the sum ``s`` of all pair distances."""
    n = F.col("n").cast("double")
    pairs = (F.col("n") * (F.col("n") - 1) / 2).cast("long")
    null = F.lit(None).cast("double")
    return sums.select("cluster_id", F.col("n").alias("n_total"), F.col("n").alias("n_used"), pairs.alias("n_pairs"),
                       F.try_divide(F.greatest("s", F.lit(0.0)), n * (n - 1) / 2).alias("avg_dist"),
                       null.alias("min_dist"), null.alias("max_dist"), null.alias("density"))


def _cosine_sum(m, zeros, u2):
    """Sum of cosine distances over all pairs of ``m`` unit vectors with squared norm ``u2`` of
    their sum, and ``zeros`` zero vectors (0 from each other, 1 from any other vector)."""
    return m * (m - 1) / 2 - (u2 - m) / 2 + m * zeros


def _combine(per_tile: DataFrame, sizes: DataFrame) -> DataFrame:
    """Tiles and ``sizes`` (``n_total``, ``n_used``) to :data:`INTRA_COLUMNS`."""
    agg = per_tile.groupBy("cluster_id").agg(
        F.sum("n_pairs").alias("n_pairs"), F.sum("s").alias("s"), F.min("mn").alias("min_dist"), F.max("mx").alias("max_dist"))
    out = agg.join(sizes, "cluster_id").withColumn("avg_dist", F.try_divide(F.col("s"), F.col("n_pairs").cast("double")))
    return out.withColumn("density", F.try_divide(F.col("avg_dist") - F.col("min_dist"),
                                                  F.col("max_dist") - F.col("min_dist"))).select(*INTRA_COLUMNS)


def _ranked(base: DataFrame, max_points: int | None) -> tuple[DataFrame, DataFrame]:
    """``base`` with each point's place ``rn`` in its cluster, cut at ``max_points``, and sizes."""
    total = base.groupBy("cluster_id").agg(F.count("*").alias("n_total"))
    if max_points is not None and max_points >= 0:
        # capped: a per-cluster row_number <= cap plans as a WindowGroupLimit
        w = Window.partitionBy("cluster_id").orderBy("_id")
        ranked = base.select("*", F.row_number().over(w).alias("rn")).where(F.col("rn") <= max_points)
        return ranked, total.withColumn("n_used", F.least("n_total", F.lit(max_points).cast("long")))
    # uncapped: distributed global rank, never one task per cluster
    from canopus.operators.topk import member_ranks
    r = member_ranks(base.select("cluster_id", "_id"), "_id", "cluster_id")
    ranked = base.join(r, ["cluster_id", "_id"]).withColumn("rn", F.col("member_rank") + 1).drop("member_rank")
    return ranked, total.withColumn("n_used", F.col("n_total"))


def _to_tiles(ranked: DataFrame, sizes: DataFrame, block: int, *cols: str) -> DataFrame:
    blk = F.floor((F.col("rn") - 1) / block).cast("int")
    nb = F.floor((F.col("n_used") - 1) / block).cast("int")
    return (ranked.join(sizes, "cluster_id")
            .select("cluster_id", "rn", *cols, blk.alias("blk"), F.explode(F.sequence(F.lit(0), nb)).alias("other"))
            .select("cluster_id", "rn", *cols, "blk", F.least("blk", "other").alias("lo"), F.greatest("blk", "other").alias("hi")))


def _manhattan_sums(base: DataFrame) -> DataFrame:
    """``(cluster_id, n, s)`` with the sum ``s`` of all pair distances: per cluster and entry, a
    value of rank i of n (from 1) is subtracted in n - i pairs and added in i - 1. Ranks come
    from one distributed sort of the values; no point is copied, no cluster is in one task."""
    sizes = base.groupBy("cluster_id").agg(F.count("*").alias("n"))
    values = base.select("cluster_id", F.posexplode("vec").alias("dim", "v"))
    ranked, _ = with_global_index(values, ["cluster_id", "dim", "v"], "_g")
    starts = ranked.groupBy("cluster_id", "dim").agg(F.min("_g").alias("_s"))
    rank = F.col("_g") - F.col("_s") + 1
    parts = (ranked.join(starts, ["cluster_id", "dim"]).join(sizes, "cluster_id")
             .groupBy("cluster_id").agg(F.sum((2 * rank - F.col("n") - 1) * F.col("v")).alias("s")))
    return sizes.join(parts, "cluster_id", "left").select("cluster_id", "n", F.coalesce("s", F.lit(0.0)).alias("s"))


def intra_stats(points: DataFrame, measure: str = "sq_euclidean", max_points: int | None = None,
                cluster_col: str = "cluster_id", id_col: str = "point_id", vec_col: str = "vec",
                block: int = 256) -> DataFrame:
    """:data:`INTRA_COLUMNS` over dense points ``(cluster, id, vec ARRAY<DOUBLE>)``."""
    base = points.select(F.col(cluster_col).cast("int").alias("cluster_id"), F.col(id_col).alias("_id"),
                         F.col(vec_col).alias("vec"))
    if max_points is None and measure in ("sq_euclidean", "cosine"):
        from pyspark.ml.functions import array_to_vector, vector_to_array
        from pyspark.ml.stat import Summarizer
        x2 = F.aggregate("vec", F.lit(0.0), lambda a, v: a + v * v)
        rows = base.withColumn("x2", x2)
        if measure == "cosine":
            rows = rows.withColumn("vec", F.when(F.col("x2") > 0, F.transform("vec", lambda v: v / F.sqrt("x2"))).otherwise(F.col("vec")))
        agg = rows.groupBy("cluster_id").agg(
            F.count("*").alias("n"), F.sum("x2").alias("x2"), F.sum((F.col("x2") > 0).cast("double")).alias("m"),
            vector_to_array(Summarizer.sum(array_to_vector("vec"))).alias("v"))
        agg = agg.withColumn("v2", F.aggregate("v", F.lit(0.0), lambda a, v: a + v * v))
        total = (F.col("n") * F.col("x2") - F.col("v2") if measure == "sq_euclidean"
                 else _cosine_sum(F.col("m"), F.col("n") - F.col("m"), F.col("v2")))
        return _average_only(agg.select("cluster_id", "n", total.alias("s")))
    if max_points is None and measure == "manhattan":
        return _average_only(_manhattan_sums(base))
    ranked, sizes = _ranked(base, max_points)
    tiled = _to_tiles(ranked, sizes, block, "vec")
    return _combine(tiled.groupBy("cluster_id", "lo", "hi").applyInPandas(_tile_fn(measure), TILE_SCHEMA), sizes)


PIVOTS = 32          # sampled points that neighbours are found by
PACK_BITS = 10       # a pack of a cluster has at most 2 ** PACK_BITS points
#: A measure as a metric, and back: pairs of distances are bounded by the triangle inequality.
_METRICS = {"sq_euclidean": (np.sqrt, np.square), "euclidean": (np.asarray, np.asarray), "manhattan": (np.asarray, np.asarray),
            "chebyshev": (np.asarray, np.asarray)}


def _extreme_packs(base: DataFrame, measure: str) -> DataFrame:
    """Packs of neighbouring points of one cluster: those nearest to one pivot, by distance. A
    number is the cluster's place, the pivot and the place among its points."""
    from canopus.operators.kmeans import assign_dense, random_seeds
    seeds = random_seeds(base.select("_id"), PIVOTS, 7, "_id")
    pivots = [list(r["vec"]) for r in base.join(seeds.select("_id"), "_id").select("vec").limit(PIVOTS).collect()]   # a few points
    near = assign_dense(base.withColumnRenamed("cluster_id", "_cluster"), pivots, measure).select(
        F.col("_cluster"), "_id", "vec", F.col("cluster_id").alias("_pivot"), F.col("distance").alias("_d"))
    ranked, _ = with_global_index(near, ["_cluster", "_pivot", "_d", "_id"], "_g")
    starts = ranked.groupBy("_cluster", "_pivot").agg(F.min("_g").alias("_s"))
    clusters, _ = with_global_index(starts.select("_cluster").distinct(), ["_cluster"], "_c")
    no = F.shiftleft(F.col("_c"), 40) + F.shiftleft(F.col("_pivot").cast("long"), 34) + F.col("_g") - F.col("_s")
    rows = ranked.join(starts, ["_cluster", "_pivot"]).join(clusters, "_cluster").select(no.alias("no"), F.col("vec").alias("val"))
    return pack(rows, points=1 << PACK_BITS, pack_bits=PACK_BITS)


def _balls(block, bits: int) -> list[tuple[int, int, int, int]]:
    """``(cluster, pack, first, end)`` of the packs in a block."""
    key = block.nos >> bits
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return [(int(block.nos[a] >> 40), int(key[a]), int(a), int(b)) for a, b in zip(first, [*first[1:], len(key)], strict=True)]


def _extremes_fn(measure: str, bits: int):
    """For each pack beside a tile, least and largest distance to its cluster's later packs. A
    pair of packs is opened only if the bounds by their balls (mean and radius) can beat the
    cluster's best so far."""
    to_metric, back = _METRICS[measure]
    tile_of = distance(measure).tile

    def ball(x):
        mid = x.mean(axis=0)
        return mid, float(to_metric(tile_of(x, mid[None, :])).max())

    def run(batches):
        best: dict[int, list[float]] = {}
        floor: dict[int, float] = {}   # the means of two packs are no farther apart than some pair of their points
        tile = parts = mids = radii = None
        for batch in batches:
            for i in range(batch.num_rows):
                own = read_block(batch, i)
                if tile is None:   # the same for all rows of the job
                    tile = read_block(batch, i, "t_")
                    matrix = tile.matrix().copy()
                    parts = _balls(tile, bits)
                    balls = [ball(matrix[a:b]) for _, _, a, b in parts]
                    mids, radii = np.array([m for m, _ in balls]), np.array([r for _, r in balls])
                x = own.matrix()
                cluster, mine = int(own.nos[0] >> 40), int(own.nos[0] >> bits)
                low, high = batch.column("mn")[i].as_py(), batch.column("mx")[i].as_py()
                so_far = best.setdefault(cluster, [np.inf if low is None else low, -np.inf if high is None else high])
                mid, radius = ball(x)
                apart = to_metric(tile_of(mid[None, :], mids))[0]
                slack = 1e-9 * (1.0 + apart + radii + radius)
                lower, upper = back(np.maximum(apart - radii - radius - slack, 0.0)), back(apart + radii + radius + slack)
                pairs = opened = 0
                at = [k for k, p in enumerate(parts) if p[0] == cluster and p[1] > mine]
                floor[cluster] = max([floor.get(cluster, -np.inf), *(float(back(max(apart[k] - slack[k], 0.0))) for k in at)])
                for k in sorted(at, key=lambda k: -upper[k]):
                    pairs += 1
                    if lower[k] < so_far[0] or upper[k] > max(so_far[1], floor[cluster]):
                        opened += 1
                        d = tile_of(x, matrix[parts[k][2]:parts[k][3]])
                        so_far[0], so_far[1] = min(so_far[0], float(d.min())), max(so_far[1], float(d.max()))
                found = [v if np.isfinite(v) else None for v in so_far]
                yield pa.RecordBatch.from_arrays([pa.array([cluster]), *(pa.array([v], pa.float64()) for v in found), pa.array([pairs]), pa.array([opened])],
                                                 names=["_c", "mn", "mx", "pairs", "opened"])
    return run


def intra_extremes(points: DataFrame, measure: str = "sq_euclidean", cluster_col: str = "cluster_id", id_col: str = "point_id",
                   vec_col: str = "vec") -> DataFrame:
    """``(cluster_id, min_dist, max_dist, tiles, opened)`` over all pairs of all points of a cluster:
    exact, by branch and bound. Points are packed with their neighbours (nearest of some
    pivots); a pack's own pairs give first bests; then packs go past tiles of all packs and
    open only pairs of packs whose bounds can beat the best. No pair of points is a row."""
    if measure not in _METRICS:
        raise ValueError(f"measure {measure!r} is no metric here; known: {sorted(_METRICS)}")
    base = points.select(F.col(cluster_col).cast("int").alias("cluster_id"), F.col(id_col).alias("_id"), F.col(vec_col).alias("vec"))
    packs = _extreme_packs(base, measure)
    tile_of = distance(measure).tile

    def inside(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                own = read_block(batch, i)
                x, n = own.matrix(), len(own)
                d = tile_of(x, x)[np.triu_indices(n, 1)] if n > 1 else None
                yield pa.RecordBatch.from_arrays([pa.array([int(own.nos[0] >> 40)]), pa.array([None if d is None else float(d.min())], pa.float64()),
                                                  pa.array([None if d is None else float(d.max())], pa.float64())], names=["_c", "mn", "mx"])
    first = cut_lineage(packs.mapInArrow(inside, "_c long, mn double, mx double").groupBy("_c").agg(F.min("mn").alias("mn"), F.max("mx").alias("mx")))
    tiled, n = tiles(packs)
    known = tiled.withColumn("_c", F.shiftright("pack", 40 - PACK_BITS)).join(first, "_c")   # k rows
    parts = [with_tile(known, one_pack(tiled.where(F.col("tile") == i).drop("tile"))).mapInArrow(
        _extremes_fn(measure, PACK_BITS), "_c long, mn double, mx double, pairs long, opened long") for i in range(n)]
    if not parts:
        return points.sparkSession.createDataFrame([], "cluster_id int, min_dist double, max_dist double, tiles long, opened long")
    found = reduce(DataFrame.unionByName, parts).groupBy("_c").agg(
        F.min("mn").alias("min_dist"), F.max("mx").alias("max_dist"), F.sum("pairs").alias("tiles"), F.sum("opened").alias("opened"))
    clusters, _ = with_global_index(base.select("cluster_id").distinct(), ["cluster_id"], "_c")
    return found.join(clusters, "_c").select("cluster_id", "min_dist", "max_dist", "tiles", "opened")


def intra_stats_full(points: DataFrame, measure: str = "sq_euclidean", cluster_col: str = "cluster_id", id_col: str = "point_id",
                     vec_col: str = "vec") -> DataFrame:
    """:data:`INTRA_COLUMNS` over all points of every cluster: averages by the closed forms,
    minimum and maximum by :func:`intra_extremes`, density from both."""
    mean = intra_stats(points, measure, None, cluster_col, id_col, vec_col).drop("min_dist", "max_dist", "density")
    out = mean.join(intra_extremes(points, measure, cluster_col, id_col, vec_col), "cluster_id")
    return out.withColumn("density", F.try_divide(F.col("avg_dist") - F.col("min_dist"), F.col("max_dist") - F.col("min_dist"))).select(*INTRA_COLUMNS)


def label_centroids(points: DataFrame, cluster_col: str = "label", vec_col: str = "vec") -> DataFrame:
    """Mean vector per cluster for dense points: ``(cluster_id, center)``."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    return points.groupBy(F.col(cluster_col).cast("int").alias("cluster_id")).agg(
        vector_to_array(Summarizer.mean(array_to_vector(vec_col))).alias("center"))


def _numbered(centers: DataFrame) -> tuple[DataFrame, int]:
    """``(cluster_id, _r)`` with ids numbered from 0 in order (k rows), and k."""
    ids = centers.select(F.col("cluster_id").cast("int")).distinct()
    r = ids.select("cluster_id", (F.row_number().over(Window.orderBy("cluster_id")) - 1).alias("_r"))
    return r, ids.count()


def _center_packs(centers: DataFrame) -> DataFrame:
    """Packed centres (:mod:`.blocks`), dense ``(cluster_id, center)`` or long-form sparse
    ``(cluster_id, term_id, weight)``, numbered by their cluster ids."""
    no = F.col("cluster_id").cast("long").alias("no")
    if "center" in centers.columns:
        return pack(centers.select(no, F.col("center").alias("val")))
    e = F.array_sort(F.collect_list(F.struct(F.col("term_id").cast("long").alias("term_id"), F.col("weight").cast("double").alias("weight"))))
    rows = centers.groupBy("cluster_id").agg(e.alias("_e"))
    return pack(rows.select(no, F.col("_e.term_id").alias("idx"), F.col("_e.weight").alias("val")), sparse=True)


def _center_pairs(centers: DataFrame, measure: str, fn, schema: str) -> DataFrame:
    """``fn(ids, other ids, distances, which pairs count)`` over blocks of centre pairs with
    id < other id: packs of centres beside tiles of them, so a centre is copied to tasks but
    never to its partners."""
    tiled, n = tiles(_center_packs(centers))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                own, tile = read_block(batch, i), read_block(batch, i, "t_")
                if not len(own) or not len(tile) or own.nos[0] >= tile.nos[-1]:
                    continue
                for r, c, d in distances(own, tile, measure):
                    a, b = own.nos[r:r + d.shape[0]], tile.nos[c:c + d.shape[1]]
                    counts = a[:, None] < b[None, :]
                    if counts.any():
                        yield fn(a, b, d, counts)
    packs = tiled.drop("tile")
    parts = [with_tile(packs, one_pack(packs.where(tiled["tile"] == i))).mapInArrow(run, schema) for i in range(n)]
    return reduce(DataFrame.unionByName, parts) if parts else centers.sparkSession.createDataFrame([], schema)


def _pair_rows(a, b, d, counts):
    x, y = np.nonzero(counts)
    return pa.RecordBatch.from_arrays([pa.array(a[x].astype("int32")), pa.array(b[y].astype("int32")), pa.array(d[x, y])],
                                      names=["cluster_id_1", "cluster_id_2", "distance"])


def _pair_sums(a, b, d, counts):
    d = d[counts]
    return pa.RecordBatch.from_arrays([pa.array([d.size]), pa.array([float(d.sum())]), pa.array([float(d.min())]), pa.array([float(d.max())])],
                                      names=["n_pairs", "s", "mn", "mx"])


def _has_blocks(centers: DataFrame, measure: str) -> bool:
    m = distance(measure)
    if "center" in centers.columns:
        return m.tile is not None
    if m.parts is None:
        raise ValueError(f"measure {measure!r} has no sparse form")
    return True


def inter_pairs(centers: DataFrame, measure: str = "sq_euclidean") -> DataFrame:
    """``(cluster_id_1, cluster_id_2, distance)`` for every centre pair with id_1 < id_2: the
    report's own output, k(k-1)/2 rows. A measure with expressions only has its centres copied
    to the numbers of the centres after them and joined by number."""
    if _has_blocks(centers, measure):
        return _center_pairs(centers, measure, _pair_rows, "cluster_id_1 int, cluster_id_2 int, distance double")
    ids, k = _numbered(centers)
    rows = centers.select(F.col("cluster_id").cast("int"), "center").join(ids, "cluster_id")
    after = F.when(F.col("_r") < k - 1, F.sequence(F.col("_r") + 1, F.lit(k - 1)))
    left = rows.select(F.col("cluster_id").alias("cluster_id_1"), F.col("center").alias("_a"), F.explode(after).alias("_r"))
    right = rows.select(F.col("cluster_id").alias("cluster_id_2"), F.col("center").alias("_b"), "_r")
    return left.join(right, "_r").select(
        "cluster_id_1", "cluster_id_2", distance(measure).dense(F.col("_a"), F.col("_b")).alias("distance"))


def inter_stats_of_centers(centers: DataFrame, measure: str = "sq_euclidean") -> DataFrame:
    """:func:`inter_stats` without pair rows: blocks of centre pairs return one row each (count,
    sum, minimum, maximum), so that the shuffle has as many rows as there are blocks."""
    if not _has_blocks(centers, measure):
        return inter_stats(inter_pairs(centers, measure))
    agg = _center_pairs(centers, measure, _pair_sums, "n_pairs long, s double, mn double, mx double").agg(
        F.coalesce(F.sum("n_pairs"), F.lit(0).cast("long")).alias("n_pairs"), F.max("mx").alias("max_dist"), F.min("mn").alias("min_dist"), F.sum("s").alias("s"))
    agg = agg.withColumn("avg_dist", F.try_divide(F.col("s"), F.col("n_pairs").cast("double")))
    return agg.select("n_pairs", "max_dist", "min_dist", "avg_dist", F.try_divide(
        F.col("avg_dist") - F.col("min_dist"), F.col("max_dist") - F.col("min_dist")).alias("density"))


def inter_stats(pairs: DataFrame) -> DataFrame:
    """1 row: ``(n_pairs, max_dist, min_dist, avg_dist, density)``."""
    avg = F.try_divide(F.sum("distance"), F.count("*").cast("double"))
    agg = pairs.agg(F.count("*").alias("n_pairs"), F.max("distance").alias("max_dist"),
                    F.min("distance").alias("min_dist"), avg.alias("avg_dist"))
    return agg.withColumn("density", F.try_divide(F.col("avg_dist") - F.col("min_dist"),
                                                  F.col("max_dist") - F.col("min_dist")))


def _fmt(c) -> F.Column:
    # format_string renders NULL as "null"; the report prints NaN like the original
    return F.when(c.isNull(), F.lit("NaN")).otherwise(F.format_string("%.6f", c))


def evaluation_report(intra: DataFrame, inter: DataFrame, pairs: DataFrame) -> DataFrame:
    """Report lines ``(section INT, key1 INT, key2 INT, line STRING)``; sorting by the
    first three columns gives the original's section order. The label texts are fixed values:
    a report has to read as the original's does."""
    s = lambda v: F.lit(v).cast("int")
    head1 = intra.sparkSession.range(1).select(s(0).alias("section"), s(0).alias("key1"), s(0).alias("key2"),
                                               F.lit("Cluster intra info :").alias("line"))
    per = intra.select(s(1).alias("section"), F.col("cluster_id").alias("key1"), s(0).alias("key2"),
                       F.concat(F.lit("ClusterID : "), F.col("cluster_id").cast("string"),
                                F.lit(" Intra Average Distance : "), _fmt(F.col("avg_dist")),
                                F.lit(" Intra Density : "), _fmt(F.col("density"))).alias("line"))
    labels = [("Cluster inter info :", None), ("Maximum Intercluster Distance: ", "max_dist"),
              ("Minimum Intercluster Distance: ", "min_dist"), ("Average Intercluster Distance: ", "avg_dist"),
              ("Scaled Inter-Cluster Density: ", "density")]
    glob = inter.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("k"), (F.lit(t) if c is None else F.concat(F.lit(t), _fmt(F.col(c)))).alias("line"))
        for i, (t, c) in enumerate(labels)])).alias("e")).select(
        s(2).alias("section"), F.col("e.k").cast("int").alias("key1"), s(0).alias("key2"), F.col("e.line").alias("line"))
    pl = pairs.select(s(3).alias("section"), F.col("cluster_id_1").alias("key1"), F.col("cluster_id_2").alias("key2"),
                      F.concat(F.lit("The distance between cluster : "), F.col("cluster_id_1").cast("string"),
                               F.lit(" and cluster : "), F.col("cluster_id_2").cast("string"), F.lit(" is "),
                               _fmt(F.col("distance"))).alias("line"))
    return head1.unionByName(per).unionByName(glob).unionByName(pl)


# ----------------------------------------------------------------------------- sparse vectors

def _sparse_gram(idx_a, val_a, idx_b, val_b):
    """Dot products between two lists of sparse vectors (numpy only): entries are
    grouped by term and each term adds the outer product of its weights."""
    na, nb = len(idx_a), len(idx_b)
    g = np.zeros((na, nb))
    if not na or not nb:
        return g
    ta = np.concatenate([np.asarray(i, dtype=np.int64) for i in idx_a])
    wa = np.concatenate([np.asarray(v, dtype=float) for v in val_a])
    da = np.repeat(np.arange(na), [len(i) for i in idx_a])
    tb = np.concatenate([np.asarray(i, dtype=np.int64) for i in idx_b])
    wb = np.concatenate([np.asarray(v, dtype=float) for v in val_b])
    db = np.repeat(np.arange(nb), [len(i) for i in idx_b])
    common = np.intersect1d(ta, tb)
    if not common.size:
        return g
    if (na + nb) * common.size <= DENSE_TILE_CELLS:
        # small enough: dense matrices over runs of the shared terms, one matmul each
        ka, kb = np.isin(ta, common), np.isin(tb, common)
        wa, da, wb, db = wa[ka], da[ka], wb[kb], db[kb]
        ca, cb = np.searchsorted(common, ta[ka]), np.searchsorted(common, tb[kb])
        step = max(1, DENSE_RUN_CELLS // (na + nb))
        for lo in range(0, common.size, step):
            width = min(step, common.size - lo)
            xa, xb = np.zeros((na, width)), np.zeros((nb, width))
            ia, ib = np.flatnonzero((ca >= lo) & (ca < lo + width)), np.flatnonzero((cb >= lo) & (cb < lo + width))
            np.add.at(xa, (da[ia], ca[ia] - lo), wa[ia])
            np.add.at(xb, (db[ib], cb[ib] - lo), wb[ib])
            g += xa @ xb.T
        return g
    ka, kb = np.isin(ta, common), np.isin(tb, common)
    ta, wa, da, tb, wb, db = ta[ka], wa[ka], da[ka], tb[kb], wb[kb], db[kb]
    oa, ob = np.argsort(ta, kind="stable"), np.argsort(tb, kind="stable")
    ta, wa, da, tb, wb, db = ta[oa], wa[oa], da[oa], tb[ob], wb[ob], db[ob]
    sa = np.searchsorted(ta, common)
    ea = np.searchsorted(ta, common, side="right")
    sb = np.searchsorted(tb, common)
    eb = np.searchsorted(tb, common, side="right")
    for i in range(common.size):
        np.add.at(g, (da[sa[i]:ea[i], None], db[None, sb[i]:eb[i]]), np.outer(wa[sa[i]:ea[i]], wb[sb[i]:eb[i]]))
    return g


def _sparse_tile_fn(measure: str):
    dist = distance(measure).parts
    if dist is None:
        raise ValueError(f"measure {measure!r} has no sparse form")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        cid, lo, hi = int(pdf["cluster_id"].iat[0]), int(pdf["lo"].iat[0]), int(pdf["hi"].iat[0])
        a = pdf[pdf["blk"] == lo].sort_values("rn")
        b = a if lo == hi else pdf[pdf["blk"] == hi].sort_values("rn")
        norm = lambda t: np.array([float(np.dot(np.asarray(v, float), np.asarray(v, float))) for v in t["val"]])
        g = _sparse_gram(list(a["idx"]), list(a["val"]), list(b["idx"]), list(b["val"]))
        d = dist(norm(a)[:, None], norm(b)[None, :], g)
        if lo == hi:
            d = d[np.triu_indices(len(a), 1)]
        d = d.ravel()
        if not d.size:
            return pd.DataFrame([(cid, 0, 0.0, None, None)], columns=["cluster_id", "n_pairs", "s", "mn", "mx"])
        return pd.DataFrame([(cid, int(d.size), float(d.sum()), float(d.min()), float(d.max()))],
                            columns=["cluster_id", "n_pairs", "s", "mn", "mx"])
    return run


def intra_stats_sparse(points: DataFrame, vecs: DataFrame, measure: str = "sq_euclidean",
                       max_points: int | None = None, block: int = 256) -> DataFrame:
    """:func:`intra_stats` for clustered points ``(cluster_id, doc_id)`` whose vectors are
    long-form ``(doc_id, term_id, weight)``; in tiles each document's entries travel as two
    arrays (bounded by its number of terms). A document without entries is a zero vector."""
    base = points.select(F.col("cluster_id").cast("int"), F.col("doc_id").alias("_id"))
    if max_points is None and measure in ("sq_euclidean", "cosine"):
        w = F.col("weight")
        norms = vecs.groupBy("doc_id").agg(F.sum(w * w).alias("x2")).select(F.col("doc_id").alias("_id"), "x2")
        docs = base.join(norms, "_id", "left").withColumn("x2", F.coalesce("x2", F.lit(0.0)))
        per = docs.groupBy("cluster_id").agg(F.count("*").alias("n"), F.sum("x2").alias("x2"),
                                             F.sum((F.col("x2") > 0).cast("double")).alias("m"))
        entry = w if measure == "sq_euclidean" else F.when(F.col("x2") > 0, w / F.sqrt("x2")).otherwise(0.0)
        v2 = (docs.join(vecs.withColumnRenamed("doc_id", "_id"), "_id").groupBy("cluster_id", "term_id").agg(F.sum(entry).alias("v"))
              .groupBy("cluster_id").agg(F.sum(F.col("v") * F.col("v")).alias("v2")))
        agg = per.join(v2, "cluster_id", "left").withColumn("v2", F.coalesce("v2", F.lit(0.0)))
        total = (F.col("n") * F.col("x2") - F.col("v2") if measure == "sq_euclidean"
                 else _cosine_sum(F.col("m"), F.col("n") - F.col("m"), F.col("v2")))
        return _average_only(agg.select("cluster_id", "n", total.alias("s")))
    ranked, sizes = _ranked(base, max_points)
    per_doc = vecs.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("term_id", "weight"))).alias("_e"))
    per_doc = per_doc.select(F.col("doc_id").alias("_id"), F.col("_e.term_id").alias("idx"),
                             F.col("_e.weight").alias("val"))
    ranked = ranked.join(per_doc, "_id", "left").select(
        "cluster_id", "_id", "rn", F.coalesce("idx", F.array().cast("array<int>")).alias("idx"),
        F.coalesce("val", F.array().cast("array<double>")).alias("val"))
    tiled = _to_tiles(ranked, sizes, block, "idx", "val")
    return _combine(tiled.groupBy("cluster_id", "lo", "hi").applyInPandas(_sparse_tile_fn(measure), TILE_SCHEMA), sizes)


def inter_pairs_sparse(centers: DataFrame, measure: str = "sq_euclidean") -> DataFrame:
    """:func:`inter_pairs` for long-form centres ``(cluster_id, term_id, weight)``."""
    return inter_pairs(centers, measure)
