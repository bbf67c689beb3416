"""Hard negatives with bounds along spanning trees of the anchors.

A candidate's score at an anchor is its score at the anchor's parent plus its product with
their difference, so it lies within edge length times candidate norm of the parent's score.
Anchors of one label are cut into blocks of at most ``BLOCK``; each block's minimum
spanning tree is built in a task. A task then walks the trees with a run of candidates:
the root's scores are computed, every child's are bounded from its parent's (exact or
bounded themselves), and only candidates whose bounds reach the anchor's window are
rescored. Walked twice:

* positives: same label, the window is the scores from the anchor's fifth best on;
* negatives: another label, the window is the scores that fit any of the anchor's positives
  and could still be among the first of one.

The fifth best of a task's own candidates, or those of a hashed share of all rows walked
first (``PROBE``), only raises the lower end of a window, never the result: a share of the
rows bounds the best of all rows from below. So tasks emit few rows that are not results.

Scores are whole numbers that doubles hold exactly. Trees reach the tasks in runs of at
most ``ANCHORS`` anchors, each a broadcast of bounded size; nothing else is sent to all.

Defined results: see :func:`.vectors.whole_vectors` for rows that take no part, nor do
those with a null label or id; rows of the anchor's own id are no other rows; repeated rows
are candidates each, repeated anchors count once; ties go to the smaller id; an anchor
without positives or a positive without negatives in its window has no row; an empty table
gives an empty result; other columns, texts included, are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canopus.operators.ranking import with_global_index
from canopus.session import cut_lineage

from .vectors import whole_vectors

SCALE, FIRST = 256, 5
#: Scaled entries must be below this: products of up to 128 of them then add up exactly in doubles.
LIMIT = 1 << 23
BLOCK, ANCHORS, RUN = 512, 32_768, 8_192
#: One row in so many is walked first for lower ends of windows.
PROBE = 32
FOUND = "no bigint, pos int, id bigint, score bigint"


@dataclass
class Tree:
    """Anchors of one label in walking order; ``parent`` is a place in it, -1 for the root."""
    label: int
    no: np.ndarray
    ids: np.ndarray
    x: np.ndarray
    parent: np.ndarray
    edge: np.ndarray


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order, parent (as a place in that order) and edge length of a minimum spanning tree."""
    n = len(x)
    square = (x * x).sum(axis=1)
    near = np.full(n, np.inf)
    up, open_ = np.full(n, -1), np.ones(n, bool)
    order, place = np.zeros(n, np.int64), np.zeros(n, np.int64)
    edge = np.zeros(n)
    here = 0
    for k in range(n):
        order[k], place[here], open_[here] = here, k, False
        edge[k] = np.sqrt(near[here]) if k else 0.0
        d = np.maximum(square + square[here] - 2 * (x @ x[here]), 0.0)   # exact: whole numbers
        closer = open_ & (d < near)
        near[closer], up[closer] = d[closer], here
        here = int(np.where(open_, near, np.inf).argmin())
    parent = np.where(up[order] >= 0, place[up[order]], -1)
    return order, parent, edge


def walk(tree: Tree, x: np.ndarray, window: Callable[[int], tuple[float, float]]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each anchor its place, and the candidates within its window with their scores."""
    norms = np.sqrt((x * x).sum(axis=1)) * (1 + 1e-12)
    children = np.bincount(tree.parent[tree.parent >= 0], minlength=len(tree.no))
    bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for k, up in enumerate(tree.parent.tolist()):
        low, high = window(k)
        if up < 0:
            s = x @ tree.x[k]
            at = np.flatnonzero((s >= low) & (s <= high))
            below = above = s
            yield k, at, s[at]
        else:
            slack = tree.edge[k] * norms + 1e-6
            below, above = bounds[up][0] - slack, bounds[up][1] + slack
            at = np.flatnonzero((above >= low) & (below <= high))
            if 4 * len(at) > len(x):   # most of them: one product without copying the rows
                below = above = x @ tree.x[k]
                s = below[at]
            else:
                s = x[at] @ tree.x[k]
                below[at] = above[at] = s
            fits = (s >= low) & (s <= high)
            yield k, at[fits], s[fits]
            children[up] -= 1
            if not children[up]:
                del bounds[up]
        if children[k]:
            bounds[k] = (below, above)


class Best:
    """The first of one list: highest scores, ties by smaller id, at least ``floor``."""

    def __init__(self, floor: float):
        self.floor, self.ids, self.scores = floor, np.zeros(0, np.int64), np.zeros(0)

    def add(self, ids: np.ndarray, scores: np.ndarray, most: int) -> None:
        good = scores >= self.floor
        if not good.any():
            return
        ids, scores = np.concatenate([self.ids, ids[good]]), np.concatenate([self.scores, scores[good]])
        if len(ids) > 16 * most:   # those that tie with the last stay until the sort
            edge = np.partition(scores, len(scores) - most)[len(scores) - most]
            ids, scores = ids[scores >= edge], scores[scores >= edge]
        order = np.lexsort((ids, -scores))[:most]
        self.ids, self.scores = ids[order], scores[order]
        if len(order) == most:
            self.floor = max(self.floor, self.scores[-1])


def _runs(batches: Iterator[pa.RecordBatch], size: int = RUN) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and vectors of about ``size`` candidates at a time."""
    def arrays(held):
        t = pa.Table.from_batches(held).combine_chunks()
        n = t.num_rows
        x = t.column("x").chunk(0).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, -1)
        return t.column("vec_id").to_numpy(), t.column("label").to_numpy(), x

    held, n = [], 0
    for b in batches:
        for at in range(0, b.num_rows, size):
            held.append(b.slice(at, size))
            n += held[-1].num_rows
            if n >= size:
                yield arrays(held)
                held, n = [], 0
    if n:
        yield arrays(held)


def _found(best: dict[tuple[int, int], Best]) -> Iterator[pa.RecordBatch]:
    full = [(k, b) for k, b in best.items() if len(b.ids)]
    for at in range(0, len(full), 2_000):
        part = full[at : at + 2_000]
        n = [len(b.ids) for _, b in part]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat([k[0] for k, _ in part], n).astype(np.int64)), pa.array(np.repeat([k[1] for k, _ in part], n).astype(np.int32)),
            pa.array(np.concatenate([b.ids for _, b in part]).astype(np.int64)),
            pa.array(np.concatenate([b.scores for _, b in part]).astype(np.int64))], names=["no", "pos", "id", "score"])


def _search_positives(shared, first: int):
    def run(batches):
        trees, floors = shared.value
        best: dict[tuple[int, int], Best] = {}
        for ids, labels, x in _runs(batches):
            for tree in trees:
                own = np.flatnonzero(labels == tree.label)
                if not len(own):
                    continue
                lists = [best.setdefault((no, 0), Best(floors.get((no, 0), -np.inf))) for no in tree.no.tolist()]
                for k, at, s in walk(tree, x[own], lambda k: (lists[k].floor, np.inf)):
                    other = ids[own[at]] != tree.ids[k]
                    lists[k].add(ids[own[at[other]]], s[other], first)
        yield from _found(best)
    return run


def _search_negatives(shared, first: int, percent: int):
    def run(batches):
        trees, floors, positives = shared.value
        best: dict[tuple[int, int], Best] = {}
        for ids, labels, x in _runs(batches):
            for tree in trees:
                other = np.flatnonzero(labels != tree.label)
                if not len(other):
                    continue
                lists = []
                for no in tree.no.tolist():   # a positive's scores from ``percent`` of its own on
                    lists.append([(p, best.setdefault((no, pos), Best(max(-(-percent * p // 100), floors.get((no, pos), -np.inf)))))
                                  for pos, p in positives.get(no, ()) if p >= 0])

                def window(k, lists=lists):
                    if not lists[k]:
                        return np.inf, -np.inf
                    return min(b.floor for _, b in lists[k]), max(p for p, _ in lists[k])

                for k, at, s in walk(tree, x[other], window):
                    for p, b in lists[k]:
                        fits = s <= p
                        b.add(ids[other[at[fits]]], s[fits], first)
        yield from _found(best)
    return run


def anchor_trees(anchors: DataFrame, block: int = BLOCK) -> tuple[DataFrame, int]:
    """One written row per block of anchors with its tree, and the number of anchors. Anchors
    are numbered by label, then by the signs of their first entries, so that blocks hold
    neighbours."""
    signs = F.transform(F.slice("x", 1, 8), lambda v: (v > 0).cast("int"))
    numbered, total = with_global_index(anchors.withColumn("signs", signs), ["label", "signs", "vec_id", "x"], "no")
    starts = numbered.groupBy("label").agg(F.min("no").alias("first"))
    placed = numbered.join(starts, "label").withColumn("block", F.floor((F.col("no") - F.col("first")) / block))

    def tree(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(pdf["x"].to_numpy()).astype(float)
        order, parent, edge = spanning_tree(x)
        return pd.DataFrame({"label": [int(pdf["label"].iat[0])], "first": [int(pdf["no"].min())],
                             "no": [pdf["no"].to_numpy()[order]], "ids": [pdf["vec_id"].to_numpy()[order]],
                             "x": [x[order].astype(np.int64).ravel()], "parent": [parent], "edge": [edge]})

    schema = "label long, first long, no array<bigint>, ids array<bigint>, x array<bigint>, parent array<bigint>, edge array<double>"
    return cut_lineage(placed.groupBy("label", "block").applyInPandas(tree, schema), "anchor_trees"), total


def _first(found: DataFrame, first: int) -> DataFrame:
    w = Window.partitionBy("no", "pos").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= first)


def _floors(found: DataFrame, first: int) -> dict[tuple[int, int], int]:
    """Scores of the last of full lists; of a bounded run of anchors."""
    return {(r["no"], r["pos"]): r["score"] for r in found.where(F.col("rank") == first).select("no", "pos", "score").collect()}


def hard_negatives(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding", label: Column | None = None,
                   scale: int = SCALE, first: int = FIRST, percent: int = 80, anchors_at_once: int = ANCHORS, block: int = BLOCK,
                   probe: int = PROBE) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``: for each
    anchor and each of its ``first`` best rows of the same label, the ``first`` best rows of
    other labels whose scores are at least ``percent`` of the positive's and at most it."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), (F.col("label") if label is None else label).cast("long").alias("label"),
                          F.col(vec_col).alias("_vec"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    rows = cut_lineage(whole_vectors(rows, "_vec", scale, 0, LIMIT), "negatives_rows")
    trees, total = anchor_trees(rows.where("anchor").select("vec_id", "label", "x").distinct(), block)
    rows = rows.select("vec_id", "label", "x")
    some = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(probe)) == 0)
    out = spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    for start in range(0, total, anchors_at_once):
        held = [Tree(r["label"], np.array(r["no"]), np.array(r["ids"]), np.array(r["x"], float).reshape(len(r["no"]), -1), np.array(r["parent"]), np.array(r["edge"]))
                for r in trees.where((F.col("first") >= start) & (F.col("first") < start + anchors_at_once)).collect()]   # a bounded run of anchors
        if not held:
            continue

        def search(table, task, *more, held=held):
            shared = spark.sparkContext.broadcast((held, *more))
            return table.mapInArrow(task(shared), FOUND)

        floors = _floors(_first(search(some, lambda s: _search_positives(s, first), {}), first), first)
        positives = cut_lineage(_first(search(rows, lambda s: _search_positives(s, first), floors), first), "positives")
        of_anchor: dict[int, list[tuple[int, int]]] = {}
        for r in positives.select("no", "rank", "score").collect():   # ``first`` for each of a bounded run of anchors
            of_anchor.setdefault(r["no"], []).append((r["rank"], r["score"]))
        floors = _floors(_first(search(some, lambda s: _search_negatives(s, first, percent), {}, of_anchor), first), first)
        negatives = cut_lineage(_first(search(rows, lambda s: _search_negatives(s, first, percent), floors, of_anchor), first), "negatives")
        ids = trees.where((F.col("first") >= start) & (F.col("first") < start + anchors_at_once)).select(
            F.explode(F.arrays_zip("no", "ids")).alias("a")).select(F.col("a.no").alias("no"), F.col("a.ids").alias("anchor_id"))
        pos = positives.select("no", F.col("rank").alias("pos"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        part = negatives.join(pos, ["no", "pos"]).join(ids, "no").select(
            "anchor_id", "positive_id", F.col("rank").cast("int"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        out = out.unionByName(part)
    return out
