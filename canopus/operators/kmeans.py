"""k-means with explicit seeds.

Sparse points are long-form ``(doc_id, term_id, weight)``. They are packed to a row of arrays per
document, hash-partitioned by ``doc_id`` and checkpointed once, so every iteration is:
  documents past blocks of centre postings (broadcasts of bounded size; no point is shuffled,
  however many terms the centres have)
  -> nearest centre per document (ties: lowest cluster id, distances rounded to 9 dp)
  -> sums per (cluster_id, term_id) of each task -> new centres (checkpointed).
A measure without a numpy form joins points with centroids by term instead and sums by windows.
A document sharing no term with a centre still gets that centre as a candidate
(its dot product is 0). Empty clusters keep their previous centre. The loop stops when
every centre moved by at most ``delta`` (in the chosen measure) or after ``max_iter``.

Dense points are ``(point_id, vec ARRAY<DOUBLE>)``; a few small centres travel inside the
expression as a folded literal, more of them stay a table that packed points go past tile by
tile (:mod:`.blocks`). Only seed ids, per-cluster numbers and a few small dense centres reach
the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canopus.config import KMeansConfig
from canopus.functions.distance import distance
from canopus.operators.blocks import COLUMNS, PACK_TYPES, SCHEMA, distances, one_pack, pack, read_block, tiles, with_tile
from canopus.session import cut_lineage, write_bucketed

DENSE_LITERAL_MAX = 4_096   # k x d values that may be inlined as a literal; beyond, blocks of centres are broadcast
DENSE_BLOCK_VALUES = 4_000_000   # centre values sent to the tasks at once


@dataclass
class KMeansResult:
    centers: DataFrame            # sparse: (cluster_id, term_id, weight); dense: (cluster_id, n, center)
    points: DataFrame             # (cluster_id, <id>, weight, distance)
    iterations: int
    converged: bool
    shifts: list = field(default_factory=list)


def seed_key(id_col: str, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_col).cast("string")))


def random_seeds(ids: DataFrame, k: int, seed: int, id_col: str = "doc_id") -> DataFrame:
    """``(cluster_id INT, id)`` for the k ids with the smallest md5(seed|id).
    Plans as a per-partition top-k (TakeOrderedAndProject), no global sort."""
    if k < 1:
        raise ValueError("k must be >= 1")
    top = ids.select(id_col, seed_key(id_col, seed).alias("_h")).orderBy("_h", id_col).limit(k)
    w = Window.orderBy("_h", id_col)  # over at most k rows
    return top.select((F.row_number().over(w) - 1).cast("int").alias("cluster_id"), id_col)


def above_threshold(points: DataFrame, threshold: float) -> DataFrame:
    """Classification threshold (P8): a point's density at its centre, ``1 / (1 + distance)``,
    must reach it; 0 keeps every point."""
    return points.where(1 / (1 + F.col("distance")) >= threshold) if threshold > 0 else points


# ----------------------------------------------------------------------------- sparse

BUCKET_BYTES = 128 << 20
ENTRY_BYTES = 24   # one (doc_id, term_id, weight) entry, about


def _pack_rows(batches):
    """One row of arrays, in term order, for each document of a batch of point rows."""
    for batch in batches:
        doc, idx = batch.column("doc_id"), batch.column("term_id").to_numpy()
        own = doc.dictionary_encode(null_encoding="encode").indices.to_numpy().astype(np.int64)
        order = np.argsort((own << 32) + idx, kind="stable")   # rows of a document mostly come together, in term order
        first = np.flatnonzero(np.diff(own[order], prepend=-1))
        ends = pa.array(np.append(first, len(order)).astype(np.int32))
        yield pa.RecordBatch.from_arrays([
            doc.take(pa.array(order[first])), pa.ListArray.from_arrays(ends, pa.array(idx[order])),
            pa.ListArray.from_arrays(ends, pa.array(batch.column("weight").to_numpy()[order]))], names=["doc_id", "idx", "val"])


def packed_rows(vecs: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """``(doc_id, idx, val)``, one row per document: its entries as two arrays in term order. Rows are
    packed where they are, so that arrays are shuffled, by document, and not entries."""
    pts = vecs.select("doc_id", F.col("term_id").cast("int"), F.col("weight").cast("double"))
    runs = pts.mapInArrow(_pack_rows, f"doc_id {pts.schema['doc_id'].dataType.simpleString()}, idx array<int>, val array<double>")
    runs = runs.repartition(num_partitions, "doc_id") if num_partitions else runs.repartition("doc_id")
    docs = runs.groupBy("doc_id").agg(F.collect_list(F.struct("idx", "val")).alias("_r"))
    more = F.array_sort(F.zip_with(F.flatten("_r.idx"), F.flatten("_r.val"), lambda i, w: F.struct(i.alias("i"), w.alias("w"))))
    one, run = F.size("_r") == 1, F.col("_r")[0]
    return docs.select("doc_id", F.when(one, run["idx"]).otherwise(F.transform(more, lambda e: e["i"])).alias("idx"),
                       F.when(one, run["val"]).otherwise(F.transform(more, lambda e: e["w"])).alias("val"))


def packed_points(vecs: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """:func:`packed_rows` as a doc-bucketed table. As a bucket is one scan task for good, their
    number follows the measured size (about ``BUCKET_BYTES`` each), at least one per core."""
    p = num_partitions or max(vecs.sparkSession.sparkContext.defaultParallelism, math.ceil(vecs.count() * ENTRY_BYTES / BUCKET_BYTES))
    return write_bucketed(packed_rows(vecs, p), "doc_id", p, prefix="canopus_points", dealt=True)


def long_form(packed: DataFrame) -> DataFrame:
    """``(doc_id, term_id, weight)`` of packed documents."""
    return packed.select("doc_id", "val", F.posexplode("idx").alias("_pos", "term_id")).select("doc_id", "term_id", F.col("val")[F.col("_pos")].alias("weight"))


def prepare_sparse_points(vecs: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """The long form of the doc-bucketed table of points."""
    return long_form(packed_points(vecs, num_partitions))


def centroids_by_term(cent: DataFrame, k: int) -> DataFrame:
    """``(term_id, cw ARRAY<DOUBLE>[k])``: one row per term, 0 where a centre lacks it."""
    m = F.map_from_entries(F.collect_list(F.struct(F.col("cluster_id"), F.col("weight"))))
    return cent.groupBy("term_id").agg(m.alias("_m")).select(
        "term_id", F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                               lambda j: F.coalesce(F.element_at(F.col("_m"), j), F.lit(0.0))).alias("cw"))


def assign_sparse_rows(points: DataFrame, cent: DataFrame, k: int, c2: list[float], measure: str,
                       broadcast: bool = True) -> DataFrame:
    """Per point row: ``doc_id, term_id, weight, _first, cluster_id, distance``. Packed points go past
    blocks of centre postings, so that none is shuffled; points in long form, and any with a measure
    without a numpy form, are joined with the centres by term."""
    m = distance(measure)
    if m.sparse is None:
        raise ValueError(f"measure {measure!r} has no sparse form (use sq_euclidean, euclidean or cosine)")
    if "idx" in points.columns and m.parts is not None:
        docs = past_blocks(packed_documents(points), center_postings(cent, k, c2, cent.count()), measure)
        rows = docs.select("doc_id", "val", "cluster_id", "distance", F.posexplode("idx").alias("_pos", "term_id"))
        return rows.select("doc_id", "term_id", F.col("val")[F.col("_pos")].alias("weight"), (F.col("_pos") == 0).alias("_first"), "cluster_id", "distance")
    fn, points = m.sparse, long_form(points) if "idx" in points.columns else points
    byterm = centroids_by_term(cent, k)
    if broadcast:
        byterm = F.broadcast(byterm)
    doc = Window.partitionBy("doc_id")
    w = F.col("weight")
    joined = points.join(byterm, "term_id", "left").select(
        "doc_id", "term_id", "weight",
        F.sum(w * w).over(doc).alias("_x2"),
        F.array(*[F.sum(w * F.coalesce(F.col("cw")[j], F.lit(0.0))).over(doc) for j in range(k)]).alias("_dots"),
        (F.col("term_id") == F.min("term_id").over(doc)).alias("_first"))
    cand = F.array(*[F.struct(F.round(fn(F.col("_x2"), F.lit(float(c2[j])), F.col("_dots")[j]), 9).alias("d"),
                              F.lit(j).alias("c")) for j in range(k)])
    best = F.array_min(cand)
    return joined.select("doc_id", "term_id", "weight", "_first",
                         best["c"].alias("cluster_id"), best["d"].alias("distance"))


CENTER_BLOCK_VALUES = 2_000_000   # centre entries sent to the tasks at once
DENSE_SHARE = 3                   # cells of a block's matrix for each of its entries, at most
CENTER_BLOCKS = 8                 # blocks that a task holds; past more of them documents are written in between


def _center_blocks(k: int, nnz: int) -> list[tuple[int, int]]:
    """Runs ``[lo, hi)`` of cluster ids with about ``CENTER_BLOCK_VALUES`` entries each."""
    n = max(1, min(k, math.ceil(nnz / CENTER_BLOCK_VALUES)))
    return [(k * i // n, k * (i + 1) // n) for i in range(n)]


def center_postings(cent: DataFrame, k: int, c2: list[float], nnz: int) -> list:
    """The centres as broadcasts, a block each: its run of cluster ids, its terms with the starts of
    their postings, the postings (centre, weight) and the squared norms. Of a block whose centres have
    most of its terms the weights are a matrix, a column a centre, without starts and centres."""
    out = []
    for lo, hi in _center_blocks(k, nnz):
        rows = cent.where((F.col("cluster_id") >= lo) & (F.col("cluster_id") < hi)).select("term_id", "cluster_id", "weight").toArrow()   # one block's entries
        term, c, w = (rows.column(i).to_numpy() for i in range(3))
        order = np.lexsort((c, term))
        terms, starts = np.unique(term[order].astype(np.int64), return_index=True)
        starts, c, w = np.append(starts, len(order)), c[order].astype(np.int64) - lo, w[order].astype(float)
        if len(terms) * (hi - lo) <= DENSE_SHARE * len(w):
            full = np.zeros((len(terms), hi - lo), order="F")
            np.add.at(full, (np.repeat(np.arange(len(terms)), np.diff(starts)), c), w)
            starts, c, w = None, None, full
        out.append(cent.sparkSession.sparkContext.broadcast((lo, hi, terms, starts, c, w, np.asarray(c2[lo:hi], dtype=float))))
    return out


BATCH_CELLS = 2_000_000   # (document, centre) products held at once by a task
BATCH_ENTRIES = 500_000   # document entries, and
BATCH_POSTINGS = 1_000_000   # postings that they meet
SUM_ENTRIES = 2_000_000   # sums by cluster and term that a task holds before it passes them on


def _doc_runs(lens: np.ndarray, k: int) -> list[slice]:
    """Runs of documents with about ``BATCH_ENTRIES`` entries and ``BATCH_CELLS`` products."""
    return _runs_of(np.maximum(lens, math.ceil(k * BATCH_ENTRIES / BATCH_CELLS)), BATCH_ENTRIES)


def _update_best(block, dist, idx, val, lens, best_d, best_c) -> None:
    """Updates the running best ``(distance, cluster_id)`` of documents with a block's centres.
    The dot products of some documents with all these centres are one sparse product: the
    documents' entries meet the postings of their terms, or the rows of a matrix. A centre sharing no
    term has dot product 0 and is a candidate like any other."""
    lo, hi, terms, starts, centers, weights, c2 = block
    k, ends = hi - lo, np.cumsum(lens)
    for own in _doc_runs(lens, k):
        n_docs, e = own.stop - own.start, slice(ends[own.start] - lens[own.start], ends[own.stop - 1])
        v, doc = val[e], np.repeat(np.arange(n_docs), lens[own])
        x2 = np.bincount(doc, weights=v * v, minlength=n_docs)
        dots = np.zeros(n_docs * k)
        if len(terms):
            at = np.minimum(np.searchsorted(terms, idx[e]), len(terms) - 1)
            hit = np.flatnonzero(terms[at] == idx[e])
            if starts is None:
                row, own_doc, own_v = at[hit], doc[hit], v[hit]
                for j in range(k):
                    dots[j::k] = np.bincount(own_doc, weights=own_v * weights[:, j][row], minlength=n_docs)
                hit = hit[:0]
        if len(terms) and starts is not None:
            a, n = starts[at[hit]], starts[at[hit] + 1] - starts[at[hit]]
            for part in _runs_of(n, BATCH_POSTINGS):
                m = n[part]
                pos = np.repeat(a[part] - (np.cumsum(m) - m), m) + np.arange(m.sum())
                cell = np.repeat(doc[hit[part]] * k, m) + centers[pos]
                dots += np.bincount(cell, weights=np.repeat(v[hit[part]], m) * weights[pos], minlength=n_docs * k)
        d = np.round(dist(x2[:, None], c2[None, :], dots.reshape(n_docs, k)), 9)
        j = d.argmin(axis=1)               # first minimum: lowest cluster id on ties
        dj = d[np.arange(n_docs), j]
        better = (best_c[own] < 0) | (dj < best_d[own])
        best_d[own], best_c[own] = np.where(better, dj, best_d[own]), np.where(better, lo + j, best_c[own])


def _entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Term ids, weights and numbers of entries of packed documents."""
    idx, val = batch.column("idx"), batch.column("val")
    return idx.flatten().to_numpy().astype(np.int64), val.flatten().to_numpy(), np.diff(idx.offsets.to_numpy()).astype(np.int64)


def _nearest_fn(blocks: list, dist, sums: bool):
    """Packed documents with the running best after ``blocks``, or with ``sums`` the weight sums and
    first-term counts of a task's documents per nearest cluster and term."""
    def best(batch):
        idx, val, lens = _entries(batch)
        best_d, best_c = batch.column("distance").to_numpy().copy(), batch.column("cluster_id").to_numpy().astype(np.int64)
        for b in blocks:
            _update_best(b.value, dist, idx, val, lens, best_d, best_c)
        return idx, val, lens, best_d, best_c

    def rows(batches):
        for batch in batches:
            _, _, _, best_d, best_c = best(batch)
            new = {"distance": pa.array(best_d), "cluster_id": pa.array(best_c.astype("int32"))}
            yield pa.RecordBatch.from_arrays([new.get(f.name, batch.column(i)) for i, f in enumerate(batch.schema)], names=batch.schema.names)

    def totals(batches):
        keys, s, f = np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        more = []

        def merged():
            key = np.concatenate([keys, *(x[0] for x in more)])
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.diff(key, prepend=key[0] - 1)) if len(key) else np.zeros(0, np.int64)
            both = [np.concatenate([old, *(x[i] for x in more)])[order] for i, old in ((1, s), (2, f))]
            more.clear()
            return key[first], *(np.add.reduceat(x, first) if len(first) else x for x in both)

        def out():
            return pa.RecordBatch.from_arrays([pa.array((keys >> 32).astype("int32")), pa.array(((keys & 0xFFFFFFFF) - (1 << 31)).astype("int32")),
                                               pa.array(s), pa.array(f.astype(np.int64))], names=["cluster_id", "term_id", "s", "f"])

        for batch in batches:
            idx, val, lens, _, best_c = best(batch)
            ends = np.cumsum(lens)
            for own in _doc_runs(lens, 1):
                e = slice(ends[own.start] - lens[own.start], ends[own.stop - 1])
                first = np.zeros(e.stop - e.start)
                first[ends[own] - lens[own] - e.start] = 1
                more.append(((np.repeat(best_c[own], lens[own]) << 32) + idx[e] + (1 << 31), val[e].copy(), first))
                if sum(len(x[0]) for x in more) >= SUM_ENTRIES // 2:
                    keys, s, f = merged()
                    if len(keys) > SUM_ENTRIES:
                        yield out()
                        keys, s, f = keys[:0], s[:0], f[:0]
        keys, s, f = merged()
        yield out()
    return totals if sums else rows


def packed_documents(points: DataFrame) -> DataFrame:
    """Packed documents with no nearest centre yet; ``points`` in long form or packed already."""
    packed = points if "idx" in points.columns else packed_rows(points)
    return packed.select("doc_id", "idx", "val", F.lit(0.0).alias("distance"), F.lit(-1).alias("cluster_id"))


def past_blocks(docs: DataFrame, blocks: list, measure: str, sums: bool = False) -> DataFrame:
    """Packed documents past blocks of centre postings: the documents with their nearest centre, or
    the partial sums that :func:`centroid_sums` adds up. No entry is shuffled."""
    part = distance(measure).parts
    if part is None:
        raise ValueError(f"measure {measure!r} has no sparse form (use sq_euclidean, euclidean or cosine)")
    for i in range(0, len(blocks), CENTER_BLOCKS):
        last = i + CENTER_BLOCKS >= len(blocks)
        docs = docs.mapInArrow(_nearest_fn(blocks[i:i + CENTER_BLOCKS], part, sums and last),
                               "cluster_id int, term_id int, s double, f long" if sums and last else docs.schema)
        if not last:
            docs = cut_lineage(docs, "nearest")
    return docs


def _runs_of(n: np.ndarray, most: int) -> list[slice]:
    """Runs of entries with about ``most`` postings in all."""
    if not len(n):
        return []
    run = np.cumsum(n) // most
    edges = np.flatnonzero(np.diff(run)) + 1
    return [slice(a, b) for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(n)], strict=True)]


def nearest_center_rows(points: DataFrame, cent: DataFrame, k: int, c2: list[float], measure: str, nnz: int) -> DataFrame:
    """Exact nearest centre: ``(doc_id, cluster_id, distance)``, one row per document and nothing
    larger on the way. Documents travel as one row of arrays past blocks of centre postings
    (each a broadcast of bounded size) and keep a running best."""
    return past_blocks(packed_documents(points), center_postings(cent, k, c2, nnz), measure).select("doc_id", "cluster_id", "distance")


def centroid_sums(rows: DataFrame) -> DataFrame:
    """``(cluster_id, term_id, s, f)``: weight sums and first-term counts (one per
    document) per cluster and term; partial aggregation keeps the shuffle at
    <= k x terms rows per partition."""
    return rows.groupBy("cluster_id", "term_id").agg(
        F.sum("weight").alias("s"), F.sum(F.col("_first").cast("long")).alias("f"))


def update_sparse(rows: DataFrame | None, old: DataFrame, sums: DataFrame | None = None) -> DataFrame:
    """Mean vector per cluster; clusters without members keep ``old``. The sums are read three times, so
    those of ``rows`` are written."""
    sums = cut_lineage(centroid_sums(rows)) if sums is None else sums
    sizes = sums.groupBy("cluster_id").agg(F.sum("f").alias("n")).where(F.col("n") > 0)
    new = sums.join(sizes, "cluster_id").select(
        "cluster_id", "term_id", (F.col("s") / F.col("n")).alias("weight"))
    kept = old.join(sizes, "cluster_id", "left_anti").select("cluster_id", "term_id", "weight")
    return new.unionByName(kept)


def sparse_center_stats(old: DataFrame, new: DataFrame) -> dict[int, dict]:
    """k rows: movement components and norms per cluster."""
    o = F.coalesce(F.col("o.weight"), F.lit(0.0))
    n = F.coalesce(F.col("n.weight"), F.lit(0.0))
    rows = (old.alias("o").join(new.alias("n"), ["cluster_id", "term_id"], "full")
            .groupBy("cluster_id").agg(
                F.sum(o * o).alias("o2"), F.sum(n * n).alias("n2"), F.sum(o * n).alias("dot"),
                F.count(F.col("n.weight")).alias("nnz"))
            .collect())
    return {r["cluster_id"]: r.asDict() for r in rows}


def sparse_shifts(spark, stats: dict[int, dict], k: int, measure: str) -> list[float]:
    """Movement of every centre in the measure's own sparse form (k rows)."""
    m = distance(measure)
    rows = [(j, float(stats[j]["o2"]), float(stats[j]["n2"]), float(stats[j]["dot"])) for j in sorted(stats)]
    if m.parts is not None:
        o2, n2, dot = (np.array([r[i] for r in rows]) for i in (1, 2, 3))
        moved = dict(zip([r[0] for r in rows], np.asarray(m.parts(o2, n2, dot)).tolist()))
    elif rows:
        d = m.sparse(F.col("o2"), F.col("n2"), F.col("dot")).alias("d")
        moved = {r["j"]: r["d"] for r in spark.createDataFrame(rows, "j int, o2 double, n2 double, dot double").select("j", d).collect()}
    else:
        moved = {}
    return [moved.get(j, 0.0) for j in range(k)]


def seed_centroids_sparse(points: DataFrame, seeds: DataFrame) -> DataFrame:
    """Seed vectors as centres: ``(cluster_id, term_id, weight)`` (seeds has <= k rows), of points
    in long form or packed."""
    if "idx" in points.columns:
        points = long_form(points.join(F.broadcast(seeds.select("doc_id")), "doc_id", "left_semi"))
    return points.join(F.broadcast(seeds), "doc_id").select("cluster_id", "term_id", "weight")


def kmeans_sparse(points: DataFrame, seeds_long: DataFrame, k: int, cfg: KMeansConfig = KMeansConfig(),
                  prepared: bool = False) -> KMeansResult:
    """Lloyd iterations over sparse points from centres ``seeds_long`` (cluster ids 0..k-1).
    ``points`` are long-form, or ``prepared`` by :func:`prepare_sparse_points` or, best, :func:`packed_points`."""
    pts = points if prepared else packed_points(points)
    cent = cut_lineage(seeds_long.select(F.col("cluster_id").cast("int"), F.col("term_id").cast("int"),
                                         F.col("weight").cast("double")))
    st = sparse_center_stats(cent, cent)
    c2 = [st.get(j, {}).get("n2", 0.0) or 0.0 for j in range(k)]
    nnz = sum(s["nnz"] for s in st.values())
    it, converged, shifts = 0, False, []
    packed = None
    if distance(cfg.measure).parts is not None:
        packed = packed_documents(pts if "idx" in pts.columns else cut_lineage(packed_rows(pts), "packed_points"))
    elif "idx" in pts.columns:
        pts = long_form(pts)

    def one_pass(sums: bool) -> DataFrame:
        """The written sums of the points nearest to each centre, or the points themselves."""
        if packed is None:   # a measure without a numpy form
            rows = assign_sparse_rows(pts, cent, k, c2, cfg.measure, nnz * k <= cfg.broadcast_max_values)
            return cut_lineage(centroid_sums(rows) if sums else rows.where("_first").select(*final_cols))
        blocks = center_postings(cent, k, c2, nnz)
        rows = past_blocks(packed, blocks, cfg.measure, sums)
        out = cut_lineage(rows.groupBy("cluster_id", "term_id").agg(F.sum("s").alias("s"), F.sum("f").alias("f")) if sums else rows.select(*final_cols))
        for b in blocks:
            b.destroy()
        return out

    final_cols = ("cluster_id", "doc_id", F.lit(1.0).alias("weight"), "distance")
    for it in range(1, cfg.max_iter + 1):
        sums = one_pass(sums=True)          # the one pass over the points
        new = cut_lineage(update_sparse(None, cent, sums))   # k x terms rows
        st = sparse_center_stats(cent, new)
        moved = sparse_shifts(pts.sparkSession, st, k, cfg.measure)
        shifts.append(moved)
        cent, c2 = new, [st.get(j, {}).get("n2", 0.0) or 0.0 for j in range(k)]
        nnz = sum(s["nnz"] for s in st.values())
        if all(m <= cfg.delta for m in moved):
            converged = True
            break
    final = one_pass(sums=False)   # read by every report
    return KMeansResult(cent, above_threshold(final, cfg.threshold), it, converged, shifts)


def kmeans_sparse_random(vecs: DataFrame, cfg: KMeansConfig = KMeansConfig()) -> KMeansResult:
    pts = packed_points(vecs)
    seeds = random_seeds(pts.select("doc_id"), cfg.k, cfg.seed, "doc_id")
    k = seeds.count()
    return kmeans_sparse(pts, seed_centroids_sparse(pts, seeds), k, cfg, prepared=True)


# ----------------------------------------------------------------------------- dense

def _dense_literal(c) -> Column:
    return F.array(*[F.lit(float(v)) for v in c])


def _best_dense_fn(shared, first: int, measure: str, vec_col: str):
    tile = distance(measure).tile

    def run(batches):
        for pdf in batches:
            best_d = pdf["distance"].to_numpy(dtype=float, copy=True)
            best_c = pdf["cluster_id"].to_numpy(dtype=np.int64, copy=True)
            step = max(1, DENSE_BLOCK_VALUES // len(shared.value))
            for i in range(0, len(pdf), step):
                x = np.stack([np.asarray(v, dtype=float) for v in pdf[vec_col].iloc[i:i + step]])
                d = np.round(tile(x, shared.value), 9)
                j = d.argmin(axis=1)                 # first minimum: lowest cluster id on ties
                dj = d[np.arange(len(j)), j]
                own = slice(i, i + len(j))
                better = (best_c[own] < 0) | (dj < best_d[own])
                best_d[own], best_c[own] = np.where(better, dj, best_d[own]), np.where(better, j + first, best_c[own])
            yield pdf.assign(distance=best_d, cluster_id=best_c.astype("int32"))
    return run


STRUCT_VALUES = 1_000_000   # centre values beside each point at once, for a measure without a block form


def assign_dense_structs(points: DataFrame, centers: DataFrame, measure: str, vec_col: str = "vec") -> DataFrame:
    """:func:`assign_dense` for a table of centres ``(cluster_id, center)`` and any measure: runs
    of centres are one broadcast array of structs each, of bounded size, which the measure's
    expression goes through; so the plan doesn't grow with the centres, their runs aside."""
    m = distance(measure)
    size = centers.agg(F.max("cluster_id").alias("last"), F.max(F.size("center")).alias("d")).first()
    per = max(1, STRUCT_VALUES // max(1, size["d"] or 1))
    best = F.struct(F.lit(float("inf")).alias("d"), F.lit(-1).alias("c"))
    cols = points.columns
    out = points.withColumn("_k", F.lit(0)).withColumn("_best", best)
    for first in range(0, (size["last"] + 1) if size["last"] is not None else 0, per):
        run = (centers.where((F.col("cluster_id") >= first) & (F.col("cluster_id") < first + per)).groupBy(F.lit(0).alias("_k"))
               .agg(F.array_sort(F.collect_list(F.struct(F.col("cluster_id").cast("int").alias("c"), F.col("center").alias("v")))).alias("_run")))
        cand = F.transform("_run", lambda s: F.struct(F.round(m.dense(F.col(vec_col), s["v"]), 9).alias("d"), s["c"].alias("c")))
        out = out.join(F.broadcast(run), "_k", "left").withColumn("_best", F.least("_best", F.array_min(cand))).drop("_run")
    return out.select(*cols, F.col("_best.c").alias("cluster_id"), F.col("_best.d").alias("distance"))


def assign_dense(points: DataFrame, centers: list, measure: str, vec_col: str = "vec",
                 max_k_expr: int = 32) -> DataFrame:
    """Adds ``cluster_id`` and ``distance`` (9 dp) to every point. A few small centres are
    inlined and compared by built-in expressions. Beyond that Arrow batches of points go past
    blocks of centres (each a broadcast of bounded size) and keep a running best, so neither
    the plan nor a task's memory grows with the number of centres."""
    k, d = len(centers), len(centers[0]) if centers else 0
    m = distance(measure)
    if m.tile is None and k * d > DENSE_LITERAL_MAX:
        table = points.sparkSession.createDataFrame([(j, [float(v) for v in c]) for j, c in enumerate(centers)], "cluster_id int, center array<double>")
        return assign_dense_structs(points, table, measure, vec_col)
    if m.tile is None or (k <= max_k_expr and k * d <= DENSE_LITERAL_MAX):
        cand = F.array(*[F.struct(F.round(m.dense(F.col(vec_col), _dense_literal(c)), 9).alias("d"),
                                  F.lit(j).alias("c")) for j, c in enumerate(centers)])
        best = F.array_min(cand)
        return points.select("*", best["c"].alias("cluster_id"), best["d"].alias("distance"))
    out = points.withColumn("cluster_id", F.lit(-1)).withColumn("distance", F.lit(0.0))
    step = max(1, DENSE_BLOCK_VALUES // max(1, d))
    for first in range(0, k, step):
        block = np.asarray(centers[first:first + step], dtype=float)
        out = out.mapInPandas(_best_dense_fn(points.sparkSession.sparkContext.broadcast(block), first, measure, vec_col), out.schema)
    return out


def dense_means(assigned: DataFrame, vec_col: str = "vec") -> dict[int, tuple[int, list[float]]]:
    """Size and mean per cluster, partial sums of whole vectors (k rows)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    rows = assigned.groupBy("cluster_id").agg(
        F.count("*").alias("n"), vector_to_array(Summarizer.mean(array_to_vector(vec_col))).alias("m")).collect()
    return {r["cluster_id"]: (r["n"], list(r["m"])) for r in rows}


def dense_shifts(spark, old: list, new: list, measure: str) -> list[float]:
    """Movement of every centre in the measure itself."""
    m = distance(measure)
    if m.tile is not None:
        return [float(m.tile(np.asarray([a], dtype=float), np.asarray([b], dtype=float))[0, 0]) for a, b in zip(old, new)]
    rows = spark.createDataFrame([(j, list(a), list(b)) for j, (a, b) in enumerate(zip(old, new))], "j int, a array<double>, b array<double>")
    return [r["d"] for r in rows.select("j", m.dense(F.col("a"), F.col("b")).alias("d")).orderBy("j").collect()]


def kmeans_dense(points: DataFrame, centers: list | DataFrame, cfg: KMeansConfig = KMeansConfig(),
                 id_col: str = "point_id", vec_col: str = "vec") -> KMeansResult:
    """Lloyd iterations over dense points. ``centers``: a list, or a table ``(cluster_id, center)``
    with ids 0..k-1. A few small centres travel inside the expressions; more of them stay a
    table throughout (:func:`_kmeans_dense_table`)."""
    if isinstance(centers, DataFrame):
        size = centers.agg(F.count("*").alias("k"), F.max(F.size("center")).alias("d")).first()
        if size["k"] > cfg.array_max_k or size["k"] * (size["d"] or 0) > DENSE_LITERAL_MAX:
            return _kmeans_dense_table(points, centers, cfg, id_col, vec_col)
        centers = [list(r["center"]) for r in centers.orderBy("cluster_id").collect()]   # at most DENSE_LITERAL_MAX values
    elif len(centers) > cfg.array_max_k or len(centers) * len(centers[0]) > DENSE_LITERAL_MAX:
        table = points.sparkSession.createDataFrame([(j, [float(v) for v in c]) for j, c in enumerate(centers)], "cluster_id int, center array<double>")
        return _kmeans_dense_table(points, table, cfg, id_col, vec_col)
    pts = cut_lineage(points.select(id_col, vec_col))
    centers = [list(map(float, c)) for c in centers]
    k = len(centers)
    it, converged, shifts = 0, False, []
    for it in range(1, cfg.max_iter + 1):
        means = dense_means(assign_dense(pts, centers, cfg.measure, vec_col, cfg.array_max_k), vec_col)
        new = [means[j][1] if j in means else centers[j] for j in range(k)]
        moved = dense_shifts(pts.sparkSession, centers, new, cfg.measure)
        shifts.append(moved)
        centers = new
        if all(m <= cfg.delta for m in moved):
            converged = True
            break
    final = cut_lineage(assign_dense(pts, centers, cfg.measure, vec_col, cfg.array_max_k))
    sizes = {r["cluster_id"]: r["count"] for r in final.groupBy("cluster_id").count().collect()}   # of the final centres
    out = above_threshold(final.select("cluster_id", id_col, F.lit(1.0).alias("weight"), "distance"), cfg.threshold)
    spark = points.sparkSession
    cdf = spark.createDataFrame([(j, int(sizes.get(j, 0)), centers[j]) for j in range(k)],
                                "cluster_id int, n long, center array<double>")
    return KMeansResult(cdf, out, it, converged, shifts)


# ----------------------------------------------------------------------------- dense, centres as a table

BEST_SCHEMA = f"{SCHEMA}, best_c binary, best_d binary"
SUM_VALUES = 2_000_000   # partial sums that a task holds before it passes them on


def _best_of_tile_fn(measure: str):
    """Updates the running best of packs of points with the centres of the tile beside them."""
    schema = pa.schema([*zip(COLUMNS, PACK_TYPES, strict=True), ("best_c", pa.binary()), ("best_d", pa.binary())])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                own, tile = read_block(batch, i), read_block(batch, i, "t_")
                c, d = batch.column("best_c")[i].as_py(), batch.column("best_d")[i].as_py()
                best_c = np.full(len(own), -1, dtype=np.int64) if c is None else np.frombuffer(c, "<i8").copy()
                best_d = np.full(len(own), np.inf) if d is None else np.frombuffer(d, "<f8").copy()
                for r, t, dist in distances(own, tile, measure):
                    dist = np.round(dist, 9)
                    j = dist.argmin(axis=1)          # first minimum: lowest cluster id on ties
                    dj = dist[np.arange(len(j)), j]
                    part = slice(r, r + len(j))
                    better = (best_c[part] < 0) | (dj < best_d[part])
                    best_d[part], best_c[part] = np.where(better, dj, best_d[part]), np.where(better, tile.nos[t + j], best_c[part])
                row = [*(batch.column(x)[i].as_py() for x in COLUMNS), best_c.astype("<i8").tobytes(), best_d.astype("<f8").tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, schema.types, strict=True)], schema=schema)
    return run


def nearest_center_packs(packs: DataFrame, centers: DataFrame, measure: str) -> DataFrame:
    """Packs with each point's nearest centre and distance. The packs go past one tile of centres
    after the other, each a broadcast of bounded size; between tiles they are written."""
    tiled, n = tiles(pack(centers.select(F.col("cluster_id").cast("long").alias("no"), F.col("center").alias("val"))))
    state = packs.select(*COLUMNS, F.lit(None).cast("binary").alias("best_c"), F.lit(None).cast("binary").alias("best_d"))
    for i in range(n):
        tile = one_pack(tiled.where(F.col("tile") == i))
        state = with_tile(state, tile).mapInArrow(_best_of_tile_fn(measure), BEST_SCHEMA)
        if i < n - 1:
            state = cut_lineage(state, "nearest")
    return state


def _cluster_sums(batches):
    """Sizes and sums of the points by cluster: a task's own, in runs of bounded size."""
    held: dict[int, list] = {}

    def flush():
        if held:
            yield pa.RecordBatch.from_pydict({"cluster_id": pa.array(list(held), pa.int32()), "n": pa.array([v[0] for v in held.values()], pa.int64()),
                                              "s": pa.array([v[1] for v in held.values()], pa.list_(pa.float64()))})
            held.clear()

    for batch in batches:
        for i in range(batch.num_rows):
            x = read_block(batch, i).matrix()
            c = np.frombuffer(batch.column("best_c")[i].as_py(), "<i8")
            order = np.argsort(c, kind="stable")
            ids, first = np.unique(c[order], return_index=True)
            sums, sizes = np.add.reduceat(x[order], first, axis=0), np.diff(np.append(first, len(c)))
            for j, n, s in zip(ids.tolist(), sizes.tolist(), sums, strict=True):
                old = held.get(j)
                held[j] = [n, s] if old is None else [old[0] + n, old[1] + s]
            if len(held) * x.shape[1] >= SUM_VALUES:
                yield from flush()
    yield from flush()


def _point_rows(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield pa.RecordBatch.from_arrays([
                pa.array(read_block(batch, i).nos), pa.array(np.frombuffer(batch.column("best_c")[i].as_py(), "<i8").astype("int32")),
                pa.array(np.frombuffer(batch.column("best_d")[i].as_py(), "<f8"))], names=["_no", "cluster_id", "distance"])


def _kmeans_dense_table(points: DataFrame, centers: DataFrame, cfg: KMeansConfig, id_col: str, vec_col: str) -> KMeansResult:
    """:func:`kmeans_dense` for any number of centres, which stay a written table: points are
    packed once, each iteration is one pass past tiles of centres, partial sums per task, and
    a join of the means with the old centres. One row (the largest movement) reaches the
    driver an iteration; ``shifts`` has it alone."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    m = distance(cfg.measure)
    numbered = cut_lineage(points.select(id_col, vec_col, F.monotonically_increasing_id().alias("_no")))
    blocks = m.tile is not None
    packs = pack(numbered.select(F.col("_no").alias("no"), F.col(vec_col).alias("val"))) if blocks else None
    cent = cut_lineage(centers.select(F.col("cluster_id").cast("int").alias("cluster_id"), "center"))

    def sums(cent):
        if blocks:
            parts = nearest_center_packs(packs, cent, cfg.measure).mapInArrow(_cluster_sums, "cluster_id int, n long, s array<double>")
        else:
            parts = assign_dense_structs(numbered, cent, cfg.measure, vec_col).select("cluster_id", F.lit(1).cast("long").alias("n"), F.col(vec_col).alias("s"))
        total = parts.groupBy("cluster_id").agg(F.sum("n").alias("n"), vector_to_array(Summarizer.sum(array_to_vector("s"))).alias("s"))
        return total.select("cluster_id", "n", F.transform("s", lambda v: v / F.col("n")).alias("mean"))

    it, converged, shifts = 0, False, []
    for it in range(1, cfg.max_iter + 1):
        new = cent.join(sums(cent), "cluster_id", "left").select("cluster_id", "center", F.coalesce("mean", "center").alias("mean"))
        new = cut_lineage(new.select("cluster_id", F.col("mean").alias("center"), m.dense(F.col("center"), F.col("mean")).alias("moved")))
        moved = new.agg(F.max("moved").alias("m")).first()["m"]
        shifts.append([moved])
        cent = new.drop("moved")
        if moved is None or moved <= cfg.delta:
            converged = True
            break
    if blocks:
        rows = nearest_center_packs(packs, cent, cfg.measure).mapInArrow(_point_rows, "_no long, cluster_id int, distance double")
        final = numbered.select(id_col, "_no").join(rows, "_no")
    else:
        final = assign_dense_structs(numbered, cent, cfg.measure, vec_col)
    final = cut_lineage(final.select("cluster_id", id_col, F.lit(1.0).alias("weight"), "distance"))
    sizes = final.groupBy("cluster_id").agg(F.count("*").alias("n"))
    out = cent.join(sizes, "cluster_id", "left").select("cluster_id", F.coalesce("n", F.lit(0).cast("long")).alias("n"), "center")
    return KMeansResult(out, above_threshold(final, cfg.threshold), it, converged, shifts)


def dense_seed_centers(points: DataFrame, k: int, seed: int, id_col: str = "point_id",
                       vec_col: str = "vec") -> list:
    seeds = random_seeds(points.select(id_col), k, seed, id_col)
    rows = seeds.join(points.select(id_col, vec_col), id_col).orderBy("cluster_id").collect()  # <= k rows
    return [list(r[vec_col]) for r in rows]


def kmeans_dense_random(points: DataFrame, cfg: KMeansConfig = KMeansConfig(), id_col: str = "point_id",
                        vec_col: str = "vec") -> KMeansResult:
    return kmeans_dense(points, dense_seed_centers(points, cfg.k, cfg.seed, id_col, vec_col), cfg, id_col, vec_col)
