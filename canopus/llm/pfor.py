"""Patched frame-of-reference segments: blocks of 256 ids.

A block stores its minimum and the differences from it, packed at a width that a
percentile of them fits; the others are exceptions. The segment's index has the place of
each block's packed words, so any run of ids is decoded from its blocks alone.

Layout (little-endian), in this order:

====================  =========================================================
header                ``HEADER``: magic, block length, partition, sequence number,
                      ids before this segment in its partition, ids, documents,
                      blocks, packed words, exceptions
documents             ids i64, null flags u8, lengths u32
blocks                starts u32 (in words), minima u32, widths u8, exceptions u16
packed                u32 words: value ``8 j + lane`` of a block is the ``j``-th of
                      its lane; word ``k`` of the lanes are neighbours
exceptions            places u8, differences u32
====================  =========================================================

One line feed may follow (the text writer's end of row).
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

MAGIC = b"PFR1"
BLOCK = 256
LANES = 8
DEEP = BLOCK // LANES
HEADER = struct.Struct("<4sIqqqqqqqq")
PERCENTILE = 90


def _widths(diff: np.ndarray, percentile: float) -> tuple[np.ndarray, np.ndarray]:
    """Bits of each difference, and per block the width that ``percentile`` of them fit."""
    bits = np.frexp(diff.astype(np.float64))[1].astype(np.uint8)
    k = max(0, int(np.ceil(diff.shape[1] * percentile / 100)) - 1)
    return bits, np.partition(bits, k, axis=1)[:, k]


def _pack(v: np.ndarray, w: int) -> np.ndarray:
    """Blocks (n, 256) of values below 2**w to (n, 8 w) words."""
    v = v.reshape(-1, DEEP, LANES)
    out = np.zeros((len(v), w, LANES), np.uint32)
    for j in range(DEEP):
        word, shift = divmod(j * w, 32)
        out[:, word] |= v[:, j] << np.uint32(shift)
        if shift + w > 32:
            out[:, word + 1] |= v[:, j] >> np.uint32(32 - shift)
    return out.reshape(len(v), -1)


def _unpack(words: np.ndarray, w: int) -> np.ndarray:
    words = words.reshape(-1, w, LANES)
    out = np.zeros((len(words), DEEP, LANES), np.uint32)
    mask = np.uint32((1 << w) - 1)
    for j in range(DEEP):
        word, shift = divmod(j * w, 32)
        x = words[:, word] >> np.uint32(shift)
        if shift + w > 32:
            x = x | (words[:, word + 1] << np.uint32(32 - shift))
        out[:, j] = x & mask
    return out.reshape(len(words), -1)


def encode(ids: np.ndarray, doc_ids: np.ndarray, nulls: np.ndarray, lengths: np.ndarray, partition: int = 0,
           sequence: int = 0, before: int = 0, percentile: float = PERCENTILE) -> bytes:
    ids = np.asarray(ids, np.uint32)
    n_blocks = -(-len(ids) // BLOCK)
    full = np.zeros(n_blocks * BLOCK, np.uint32)
    full[: len(ids)] = ids
    if n_blocks:
        full[len(ids):] = ids[-1]
    blocks = full.reshape(n_blocks, BLOCK)
    minima = blocks.min(axis=1) if n_blocks else np.zeros(0, np.uint32)
    diff = blocks - minima[:, None]
    bits, widths = _widths(diff, percentile) if n_blocks else (diff.astype(np.uint8), np.zeros(0, np.uint8))
    starts = np.concatenate([[0], np.cumsum(widths.astype(np.int64) * LANES)])
    packed = np.zeros(int(starts[-1]), np.uint32)
    for w in np.unique(widths):
        if w:
            at = np.flatnonzero(widths == w)
            mask = np.uint32((1 << int(w)) - 1)
            packed[starts[at][:, None] + np.arange(int(w) * LANES)] = _pack(diff[at] & mask, int(w))
    outlier = bits > widths[:, None]
    places = np.nonzero(outlier)[1].astype(np.uint8)
    values = diff[outlier]
    head = HEADER.pack(MAGIC, BLOCK, partition, sequence, before, len(ids), len(doc_ids), n_blocks, len(packed), len(places))
    return b"".join([
        head, np.asarray(doc_ids, "<i8").tobytes(), np.asarray(nulls, np.uint8).tobytes(), np.asarray(lengths, "<u4").tobytes(),
        starts[:-1].astype("<u4").tobytes(), minima.astype("<u4").tobytes(), widths.tobytes(),
        outlier.sum(axis=1).astype("<u2").tobytes(), packed.astype("<u4").tobytes(), places.tobytes(), values.astype("<u4").tobytes()])


@dataclass
class Segment:
    partition: int
    sequence: int
    before: int
    n_ids: int
    doc_ids: np.ndarray
    nulls: np.ndarray
    lengths: np.ndarray
    starts: np.ndarray
    minima: np.ndarray
    widths: np.ndarray
    exceptions: np.ndarray
    packed: np.ndarray
    places: np.ndarray
    values: np.ndarray

    def blocks(self, first: int, last: int) -> np.ndarray:
        """Ids of blocks ``first`` to ``last - 1``, padding included."""
        widths = self.widths[first:last]
        out = np.zeros((last - first, BLOCK), np.uint32)
        for w in np.unique(widths):
            if w:
                at = np.flatnonzero(widths == w)
                at_words = self.starts[first:last][at].astype(np.int64)[:, None] + np.arange(int(w) * LANES)
                out[at] = _unpack(self.packed[at_words], int(w))
        ends = np.concatenate([[0], np.cumsum(self.exceptions.astype(np.int64))])
        rows = np.repeat(np.arange(last - first), self.exceptions[first:last])
        span = slice(int(ends[first]), int(ends[last]))
        out[rows, self.places[span]] = self.values[span]
        return (out + self.minima[first:last, None]).ravel()

    def ids(self, start: int = 0, end: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``end - 1``, decoded from the blocks that hold them."""
        end = self.n_ids if end is None else min(end, self.n_ids)
        if end <= start:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK, -(-end // BLOCK)
        return self.blocks(first, last)[start - first * BLOCK : end - first * BLOCK]


def decode(data: bytes) -> Segment:
    magic, block, partition, sequence, before, n_ids, n_docs, n_blocks, n_words, n_out = HEADER.unpack_from(data)
    if magic != MAGIC or block != BLOCK:
        raise ValueError("not a segment of this format")
    at = HEADER.size
    parts = []
    for kind, n in (("<i8", n_docs), ("u1", n_docs), ("<u4", n_docs), ("<u4", n_blocks), ("<u4", n_blocks), ("u1", n_blocks),
                    ("<u2", n_blocks), ("<u4", n_words), ("u1", n_out), ("<u4", n_out)):
        parts.append(np.frombuffer(data, kind, n, at))
        at += parts[-1].nbytes
    return Segment(partition, sequence, before, n_ids, *parts)
