"""Vectors packed in rows, so that block meets block inside a task.

A *pack* is one row of up to a few thousand vectors: ``(pack, n, nos, lens, idx, val)``.
``nos`` are the vectors' numbers (8-byte integers), ``val`` their entries one after the
other (8-byte floats); sparse vectors also have ``lens`` (entries of each) and ``idx``
(term ids). Dense and sparse vectors go through the same code.

A table of packs meets a *tile*, a single pack of at most ``TILE_VALUES`` entries, by a
broadcast join on a constant: the tile is bounded by construction, stays a table, and no
vector is ever a Python object of the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopus.functions.distance import distance
from canopus.session import cut_lineage

PACK_POINTS = 1_024         # vectors of a pack at most
PACK_VALUES = 262_144       # and entries, about
TILE_VALUES = 4_000_000     # entries of a tile
SPARSE_TILE_VALUES = 1_000_000   # of sparse vectors, whose products need several times the tile
CELLS = 4_000_000           # distances held at once by a task
SCHEMA = "pack long, n long, nos binary, lens binary, idx binary, val binary"
COLUMNS = ("pack", "n", "nos", "lens", "idx", "val")


@dataclass
class Block:
    """Numbered vectors; ``lens`` and ``idx`` are empty for dense ones."""
    nos: np.ndarray
    lens: np.ndarray
    idx: np.ndarray
    val: np.ndarray

    def __len__(self) -> int:
        return len(self.nos)

    @property
    def sparse(self) -> bool:
        return len(self.lens) > 0

    def matrix(self) -> np.ndarray:
        return self.val.reshape(len(self.nos), -1)

    def take(self, keep: np.ndarray) -> Block:
        """The vectors at the places (or under the mask) ``keep``."""
        keep = np.arange(len(self))[keep]
        if not self.sparse:
            return Block(self.nos[keep], self.lens, self.idx, self.matrix()[keep].ravel() if len(self) else self.val)
        starts = np.cumsum(self.lens) - self.lens
        n = self.lens[keep].astype(np.int64)
        at = np.repeat(starts[keep] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return Block(self.nos[keep], self.lens[keep], self.idx[at], self.val[at])

    def lists(self) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """Term ids, weights and squared norms of sparse vectors."""
        ends = np.cumsum(self.lens)[:-1]
        val = np.split(self.val, ends)
        return np.split(self.idx, ends), val, np.array([float(v @ v) for v in val])

    def row(self, pack: int) -> tuple:
        return (pack, len(self), self.nos.astype("<i8").tobytes(), self.lens.astype("<i4").tobytes(),
                self.idx.astype("<i8").tobytes(), self.val.astype("<f8").tobytes())


def unpack(nos: bytes, lens: bytes, idx: bytes, val: bytes) -> Block:
    return Block(np.frombuffer(nos, "<i8"), np.frombuffer(lens, "<i4"), np.frombuffer(idx, "<i8"), np.frombuffer(val, "<f8"))


def joined(blocks: list[Block]) -> Block:
    return Block(*(np.concatenate([getattr(b, f) for b in blocks]) for f in ("nos", "lens", "idx", "val")))


def distances(a: Block, b: Block, measure: str, cells: int = CELLS) -> Iterator[tuple[int, int, np.ndarray]]:
    """``(row, column, matrix)`` parts of the distances of ``a`` to ``b``, of at most ``cells`` each."""
    m = distance(measure)
    if not len(a) or not len(b):
        return
    if a.sparse or b.sparse:
        cells //= 2   # beside the sorted entries
    rows = max(1, min(len(a), cells // len(b)))
    cols = max(1, min(len(b), cells // rows))
    if a.sparse or b.sparse:
        from canopus.operators.evaluate import _sparse_gram
        if m.parts is None:
            raise ValueError(f"measure {measure!r} has no sparse form")
        (ia, va, na), (ib, vb, nb) = a.lists(), b.lists()
        for i in range(0, len(a), rows):
            for j in range(0, len(b), cols):
                g = _sparse_gram(ia[i:i + rows], va[i:i + rows], ib[j:j + cols], vb[j:j + cols])
                yield i, j, m.parts(na[i:i + rows, None], nb[None, j:j + cols], g)
        return
    if m.tile is None:
        raise ValueError(f"measure {measure!r} has no block form")
    xa, xb = a.matrix(), b.matrix()
    for i in range(0, len(a), rows):
        for j in range(0, len(b), cols):
            yield i, j, m.tile(xa[i:i + rows], xb[j:j + cols])


def near_any(a: Block, b: Block, measure: str, limit: float) -> np.ndarray:
    """Which vectors of ``a`` are closer than ``limit`` to one of ``b``."""
    out = np.zeros(len(a), dtype=bool)
    for i, _, d in distances(a, b, measure):
        out[i:i + len(d)] |= (d < limit).any(axis=1)
    return out


def _packer(sparse: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("no")
        none = np.zeros(0, np.int64)
        if sparse:
            lens = np.array([len(v) for v in pdf["val"]], np.int64)
            b = Block(pdf["no"].to_numpy(), lens, np.concatenate([np.asarray(v, np.int64) for v in pdf["idx"]]),
                      np.concatenate([np.asarray(v, float) for v in pdf["val"]]))
        else:
            b = Block(pdf["no"].to_numpy(), none, none, np.concatenate([np.asarray(v, float) for v in pdf["val"]]))
        return pd.DataFrame([b.row(int(pdf["pack"].iat[0]))], columns=list(COLUMNS))
    return run


def pack(rows: DataFrame, sparse: bool = False, points: int = PACK_POINTS, values: int = PACK_VALUES, pack_bits: int | None = None) -> DataFrame:
    """A written table of packs from ``(no, val)`` or, if ``sparse``, ``(no, idx, val)``, a row a
    vector. Packs hold runs of numbers, so they are as even as the numbers; widths are measured
    and a pack of the widest vectors alone has at most 8 times ``values`` entries. With ``pack_bits``
    a pack is what numbers have in common but for their last bits."""
    width = rows.agg(F.max(F.size("val")).alias("most"), F.avg(F.size("val")).alias("mean")).first()
    per = max(1, min(points, int(values / max(1.0, width["mean"] or 0, (width["most"] or 0) / 8))))
    cols = ["no", *(["idx"] if sparse else []), "val"]
    number = F.shiftright("no", pack_bits) if pack_bits is not None else F.floor(F.col("no") / per)
    keyed = rows.select(*cols, number.cast("long").alias("pack"))
    return cut_lineage(keyed.groupBy("pack").applyInPandas(_packer(sparse), SCHEMA), "packs")


def read_block(batch: pa.RecordBatch, i: int, prefix: str = "") -> Block:
    return unpack(*(batch.column(prefix + c)[i].as_buffer() for c in COLUMNS[2:]))


def unpacked(packs: DataFrame, sparse: bool = False) -> DataFrame:
    """``(no, val)`` or ``(no, idx, val)``: a row a vector again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                b = read_block(batch, i)
                lens = b.lens if sparse else np.full(len(b), len(b.val) // max(1, len(b)))
                ends = pa.array(np.concatenate([[0], np.cumsum(lens)]).astype(np.int32))
                val = pa.ListArray.from_arrays(ends, pa.array(b.val))
                cols = [pa.array(b.nos), pa.ListArray.from_arrays(ends, pa.array(b.idx)), val] if sparse else [pa.array(b.nos), val]
                yield pa.RecordBatch.from_arrays(cols, names=["no", "idx", "val"] if sparse else ["no", "val"])
    return packs.mapInArrow(run, f"no long, {'idx array<long>, ' if sparse else ''}val array<double>")


def one_pack(packs: DataFrame) -> DataFrame:
    """All of a bounded table of packs as a tile: one pack in the order of the numbers."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        b = joined([unpack(*(r[c] for c in COLUMNS[2:])) for _, r in pdf.sort_values("pack").iterrows()])
        return pd.DataFrame([b.row(0)], columns=list(COLUMNS))
    return packs.groupBy(F.lit(0).alias("_all")).applyInPandas(run, SCHEMA)


def with_tile(packs: DataFrame, tile: DataFrame) -> DataFrame:
    """``packs`` with the only row of ``tile`` beside each, its columns named ``t_...``."""
    t = tile.select(F.lit(0).alias("_tile"), *(F.col(c).alias(f"t_{c}") for c in COLUMNS[2:]))
    return packs.withColumn("_tile", F.lit(0)).join(F.broadcast(t), "_tile").drop("_tile")


def per_pack_and_tile(fn: Callable[[int, Block, Block], Iterator[tuple]], names, types: list):
    """A task function over rows of :func:`with_tile`: ``fn(pack, block, tile)`` yields rows."""
    schema = pa.schema(list(zip(names, types, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                rows = list(fn(b.column("pack")[i].as_py(), read_block(b, i), read_block(b, i, "t_")))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], schema=schema)
    return run


PACK_TYPES = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]


def tiles(packs: DataFrame, values: int = TILE_VALUES) -> tuple[DataFrame, int]:
    """``packs`` with the tile ``tile`` each belongs to, and the number of tiles: runs of packs
    of about ``values`` entries. Only sizes by pack are summed up, in one sort of them."""
    from canopus.operators.ranking import with_global_index
    sizes = packs.select("pack", F.floor(F.octet_length("val") / 8).alias("w"))
    most = sizes.agg(F.max("w").alias("w")).first()["w"]
    if most is None:
        return packs.withColumn("tile", F.lit(0)), 0
    per = max(1, values // max(1, most))
    placed, n = with_global_index(sizes.select("pack"), ["pack"], "_place")
    placed = placed.select("pack", F.floor(F.col("_place") / per).cast("int").alias("tile"))
    return cut_lineage(packs.join(placed, "pack"), "tiles"), -(-n // per)

