"""SimHash near-duplicates by a binary trie self-join.

A document's fingerprint has a bit set if it is set in over half the hashes of its word
shingles. Two fingerprints link at ``max_bits`` or fewer differing bits; a document's
component is the smallest id it reaches.

The trie of all fingerprints is searched in parts. Fingerprints that differ in at most k
bits agree on one of k + 1 runs of bits, so each is sent once per run, keyed by the run's
value: a key's fingerprints are one subtrie, whose paths agree so far. Within it pairs of
nodes are traversed together from (root, root): each step goes to the children, adds a
differing bit for unequal ones and drops the pair once the error budget is exceeded. Keys
with more than ``max_group`` fingerprints are split again on their remaining bits by the
same rule, so no task gets an unbounded group.

A task reports a spanning forest of what it links, never all pairs: node pairs whose
leaves are linked already are left alone. The forests are joined into components by
alternating big and small stars on DataFrames.

Defined results: null, empty and blank texts have fingerprint 0 and link like any other;
repeated rows and texts share one node; null ids get the smallest id of their component
(null if it has none); a bit set in exactly half the hashes is 0; a very long text is hashed
whole; an empty table gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopus.session import cut_lineage

from .common import broadcast_if_small, by_key, chunks, text_key

SHINGLE = 3
MAX_BITS = 3
BITS = 64
SEED = 42
MAX_GROUP = 50_000
_PAIRS = 1 << 20   # node pairs expanded at a time

_COUNTS = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


# ------------------------------------------------------------------ fingerprints

def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Of a UTF-8 text: A-Z lower-cased, words between ASCII white space."""
    from xxhash import xxh64_intdigest

    w = text.lower().split()   # of bytes: ASCII letters and ASCII white space only
    if not w:
        return 0
    found = map(b" ".join, zip(*(w[i:] for i in range(shingle)), strict=False)) if len(w) >= shingle else [b" ".join(w)]
    h = np.array([xxh64_intdigest(s, SEED) for s in found], "<u8")
    # bits in chunks: a long text's bit table stays small
    ones = np.zeros(BITS, np.int64)
    for a in range(0, len(h), 4096):
        ones += np.unpackbits(h[a : a + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_key, fp)``, the 64 bits as a signed long."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t, shingle) for _, part in chunks(b.column("text")) for t in part]
            cols = [b.column("doc_id"), b.column("text_key"), pa.array(np.array(fps, np.uint64).view(np.int64))]
            yield pa.RecordBatch.from_arrays(cols, schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(text_col).alias("text_key"),
                       F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, text_key bigint, fp bigint")


# ------------------------------------------------------------------ trie self-join of one task

def popcount(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    return sum(_COUNTS[(x >> np.uint64(16 * i) & np.uint64(0xFFFF)).astype(np.int64)].astype(np.int64) for i in range(4))


def _roots(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component labels (smallest index) after linking ``a[i]`` with ``b[i]``."""
    label = label.copy()
    while True:
        x, y = label[a], label[b]
        todo = x != y
        if not todo.any():
            return label
        a, b, x, y = a[todo], b[todo], x[todo], y[todo]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def trie_components(fps: np.ndarray, bounds: np.ndarray, max_bits: int) -> np.ndarray:
    """``fps`` sorted within the groups ``bounds[g]:bounds[g + 1]``. Labels (an index of the
    same component) after linking, within each group, all pairs at most ``max_bits`` apart.

    A node is a run ``lo:hi`` of a group at a depth: its fingerprints share the bits above.
    """
    label = np.arange(len(fps))
    near = np.flatnonzero(popcount(fps[1:] ^ fps[:-1]) <= max_bits)
    near = near[np.searchsorted(bounds, near, "right") == np.searchsorted(bounds, near + 1, "right")]
    label = _roots(label, near, near + 1)
    big = np.flatnonzero(np.diff(bounds) > 1)
    lo, hi = bounds[big], bounds[big + 1]
    stack = [(0, lo, hi, lo, hi, np.zeros(len(lo), np.int64))]
    key = fps.astype(np.uint64)
    while stack:
        depth, alo, ahi, blo, bhi, err = stack.pop()
        if len(alo) > _PAIRS:
            for at in range(0, len(alo), _PAIRS):
                stack.append((depth, *(x[at : at + _PAIRS] for x in (alo, ahi, blo, bhi, err))))
            continue
        # pairs whose leaves are linked already add nothing
        change = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])])
        linked = (change[ahi - 1] == change[alo]) & (change[bhi - 1] == change[blo]) & (label[alo] == label[blo])
        alo, ahi, blo, bhi, err = (x[~linked] for x in (alo, ahi, blo, bhi, err))
        # two leaves: compare the rest of their paths at once
        leaf = (ahi - alo == 1) & (bhi - blo == 1)
        if leaf.any():
            x, y = alo[leaf], blo[leaf]
            ok = popcount(key[x] ^ key[y]) <= max_bits
            label = _roots(label, x[ok], y[ok])
            alo, ahi, blo, bhi, err = (v[~leaf] for v in (alo, ahi, blo, bhi, err))
        if not len(alo) or depth >= BITS:
            continue
        amid, bmid = _middle(key, alo, ahi, depth), _middle(key, blo, bhi, depth)
        same = (alo == blo) & (ahi == bhi)
        children = [(alo, amid, blo, bmid, err, None), (amid, ahi, bmid, bhi, err, None),
                    (alo, amid, bmid, bhi, err + 1, None), (amid, ahi, blo, bmid, err + 1, ~same)]   # a node with itself: once
        out = []
        for cal, cah, cbl, cbh, e, only in children:
            ok = (cal < cah) & (cbl < cbh) & (e <= max_bits)
            ok &= ~((cal == cbl) & (cah - cal == 1) & (cbh - cbl == 1))   # a leaf with itself
            if only is not None:
                ok &= only
            out.append([x[ok] for x in (cal, cah, cbl, cbh, e)])
        merged = [np.concatenate(c) for c in zip(*out, strict=True)]
        if len(merged[0]):
            stack.append((depth + 1, *merged))
    return label


def _middle(key: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
    """First place in ``lo:hi`` whose bit at ``depth`` is set (bits above are equal there)."""
    bit = np.uint64(1) << np.uint64(BITS - 1 - depth)
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) // 2
        one = (key[np.minimum(mid, len(key) - 1)] & bit) != 0
        hi = np.where(open_ & one, mid, hi)
        lo = np.where(open_ & ~one, mid + 1, lo)


# ------------------------------------------------------------------ links of all fingerprints

def _runs(free: list[int], n: int) -> list[list[int]]:
    """``free`` bit numbers in ``n`` runs of about equal length."""
    return [free[len(free) * i // n : len(free) * (i + 1) // n] for i in range(n)]


def _take(col: str, bits: list[int]):
    """The bits (highest first) of a long column as a number: one shift and mask per stretch
    of neighbouring bits."""
    out, i, left = None, 0, len(bits)
    while i < len(bits):
        j = i
        while j + 1 < len(bits) and bits[j + 1] == bits[j] - 1:
            j += 1
        n = j - i + 1
        left -= n
        part = F.shiftrightunsigned(col, bits[j]).bitwiseAND(F.lit((1 << n) - 1))
        part = F.shiftleft(part, left) if left else part
        out = part if out is None else out.bitwiseOR(part)
        i = j + 1
    return out


def links(distinct: DataFrame, max_bits: int = MAX_BITS, max_group: int = MAX_GROUP) -> DataFrame:
    """Links ``(a, b)``, ``b < a``, between fingerprints, which join the same ones as all pairs
    at most ``max_bits`` apart. ``distinct`` is ``(fp)``, each once, and written."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def solve(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            bounds = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
            root = trie_components(fps.view(np.uint64), bounds, max_bits)
            at = np.flatnonzero(root != np.arange(len(root)))
            x, y = fps[at], fps[root[at]]
            return pa.RecordBatch.from_arrays([pa.array(np.maximum(x, y)), pa.array(np.minimum(x, y))], schema=schema)

        for b in batches:
            keys, fps = (b.column(c).to_numpy(zero_copy_only=False) for c in ("key", "fp"))
            held.append((keys, fps))
            size += len(keys)
            if size > 4 * max_group:   # whole groups go; the last may go on in the next batch
                keys, fps = (np.concatenate(x) for x in zip(*held, strict=True))
                cut = int(np.searchsorted(keys, keys[-1]))
                if cut:
                    yield solve(keys[:cut], fps[:cut])
                held, size = [(keys[cut:], fps[cut:])], len(keys) - cut
        if size:
            yield solve(*(np.concatenate(x) for x in zip(*held, strict=True)))

    found = None
    # (rows with their key so far, bits not fixed yet)
    todo = [(distinct.select("fp", F.lit(0).cast("long").alias("key")), list(range(BITS - 1, -1, -1)))]
    while todo:
        rows, free = todo.pop()
        split = [(rows.select("fp", F.xxhash64("key", F.lit(i), _take("fp", run)).alias("key")), [x for x in free if x not in run])
                 for i, run in enumerate(_runs(free, max_bits + 1))]
        last = len(free) < 2 * (max_bits + 1)
        small = []
        for part, rest in split:
            if last or not rest:
                small.append(part)
                continue
            hot = cut_lineage(part.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > max_group).select("key"), "hot_keys")
            if hot.isEmpty():
                small.append(part)
                continue
            hot = broadcast_if_small(hot)
            small.append(part.join(hot, "key", "left_anti"))
            todo.append((cut_lineage(part.join(hot, "key", "left_semi"), "hot_rows"), rest))
        for part in small:
            found = part if found is None else found.unionByName(part)
    # signed order is trie order from the second bit on; the sign bit's two halves are sorted as unsigned
    return (found.repartition("key").sortWithinPartitions("key", F.col("fp").bitwiseXOR(F.lit(-(1 << 63))))
            .mapInArrow(forest, "a bigint, b bigint"))


# ------------------------------------------------------------------ components

def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(a, root)`` for every node that isn't its component's smallest. Alternates big stars
    (a node's larger neighbours go to its smallest) and small stars (its smaller ones do)."""
    edges = cut_lineage(edges.distinct(), "edges")
    if edges.isEmpty():
        return edges.select("a", F.col("b").alias("root"))
    state = _state(edges)
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # big star: for b > a, (b, m)
        edges = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        edges = cut_lineage(edges, "big_star")
        # small star: for b < a, (b, m) and (a, m)
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        near = edges.join(least, "a")
        edges = (near.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        edges = cut_lineage(edges, "small_star")
        now = _state(edges)
        if now == state:
            return edges.select("a", F.col("b").alias("root"))
        state = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, max_group: int = MAX_GROUP,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, component_id, first, text_key)`` per row; ``first`` is true for
    the component's row to keep: the smallest id, then the smallest text key."""
    rows = cut_lineage(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    distinct = cut_lineage(rows.groupBy("fp").agg(F.min(row).alias("least")), "distinct_fingerprints")
    roots = components(links(distinct.select("fp"), max_bits, max_group))
    classes = distinct.join(roots.select(F.col("a").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = classes.groupBy("root").agg(F.min("least").alias("least"))
    of_fp = classes.select("fp", "root").join(smallest, "root").select("fp", "least")
    first = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_key") == F.col("least.text_key"))
    return rows.join(of_fp, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("least.doc_id").alias("component_id"),
        first.alias("first"), "text_key")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component, all columns as they are. Rows of equal id and
    text are one document: of those any one stays."""
    found = cut_lineage(near_duplicates(docs, shingle, max_bits).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "first"),
                        "near_duplicates")
    dropped = cut_lineage(found.where(~F.col("first")).select("_id", "_key").distinct(), "dropped")
    kept = by_key(docs, dropped, text_key(), "left_anti")
    again = cut_lineage(found.where("first").groupBy("_id", "_key").count().where("count > 1").select("_id", "_key"), "repeated")
    if again.isEmpty():
        return kept
    once = by_key(kept, again, text_key(), "left_semi").dropDuplicates(["doc_id", "text"])
    return by_key(kept, again, text_key(), "left_anti").unionByName(once)
