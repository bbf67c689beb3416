"""Token counts per document by a map-side two-tier lookup.

The library's count of a text is the sum of its counts over *pre-tokens*: a run of
spaces with the word after it, or one line feed. That holds because no piece of the
vocabulary has a space after another character, or a line feed
(:func:`assert_splittable`), so no merge crosses such a border.

Tier one is a broadcast table of the corpus's frequent pre-tokens with their lengths;
its size is bounded (``table_size`` entries). It comes from one pass in which each task
keeps a bounded frequency summary (Misra-Gries) of *all* its pre-tokens; the summaries
are merged in a tree, so no pre-token is ever shuffled. Tier two encodes a miss once per
Python worker and keeps its length in a bounded cache. A miss in either tier costs time,
never exactness. Texts are split as Arrow columns, in runs of some megabytes; a run's
different pre-tokens alone become Python objects.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows are counted
each, and ties among frequent pre-tokens only decide which tier answers; an empty table gives
an empty result; a very long text is counted whole, as a run of its own; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A space, or the mark that the library writes for it.
_MARK = "▁"
_PARTS = re.compile(r" *[^ ]+| +")
CACHE_ENTRIES = 400_000
_LONGEST_KEY = 200
RUN_BYTES = 8_000_000
FAN_IN = 16
TABLE_SIZE = 16_384

_worker: dict[str, PieceCounter] = {}


def assert_splittable(pieces: list[str]) -> None:
    for p in pieces:
        if "\n" in p or re.search(f"[^{_MARK}]{_MARK}", p):
            raise ValueError(f"piece {p!r} crosses a pre-token border: count whole texts instead")


class Split:
    """The pre-tokens of a run of texts. Lines are split at spaces: a line's first part stands
    without a space (``bare``), each other one with the space before it (``spaced``). Lines with
    more than one space in a row, or one at the end, are ``odd`` and split by a pattern."""

    def __init__(self, texts: pa.Array):
        texts = pc.replace_substring(texts, _MARK, " ")
        # the library puts a space before the text
        texts = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(" ", texts, ""))
        by_text = pc.split_pattern(texts, "\n")
        lines = by_text.flatten()
        by_line = pc.split_pattern(lines, " ")
        parts = by_line.flatten().dictionary_encode()
        self.words, self.codes = parts.dictionary, parts.indices.to_numpy(zero_copy_only=False)
        self.lines = by_text.offsets.to_numpy() - by_text.offsets[0].as_py()
        self.parts = by_line.offsets.to_numpy() - by_line.offsets[0].as_py()
        nothing = self.codes == pc.index(self.words, "").as_py()
        first = np.zeros(len(self.codes), bool)
        first[self.parts[:-1]] = True
        odd = np.zeros(len(lines), bool)
        odd[np.searchsorted(self.parts, np.flatnonzero(nothing & ~first), "right") - 1] = True
        usual = ~nothing & ~np.repeat(odd, np.diff(self.parts))
        self.spaced, self.bare = usual & ~first, usual & first
        self.odd = np.flatnonzero(odd)
        self.odd_parts = [_PARTS.findall(x) for x in lines.filter(pa.array(odd)).to_pylist()]

    def different(self, where: np.ndarray, before: str) -> tuple[np.ndarray, list[str], np.ndarray]:
        """Of the parts ``where``: codes of the different ones, themselves behind ``before``, and
        how often each is there."""
        n = np.bincount(self.codes[where], minlength=len(self.words))
        codes = np.flatnonzero(n)
        return codes, pc.binary_join_element_wise(before, self.words.take(pa.array(codes)), "").to_numpy(zero_copy_only=False).tolist(), n[codes]

    def pre_tokens(self) -> Iterator[tuple[str, int]]:
        for where, before in ((self.spaced, " "), (self.bare, "")):
            _, keys, n = self.different(where, before)
            yield from zip(keys, n.tolist(), strict=True)
        yield from Counter(p for parts in self.odd_parts for p in parts).items()


class PieceCounter:
    """Counts tokens of texts with the sentencepiece model at ``path``."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        assert_splittable([self.model.id_to_piece(i) for i in range(self.model.get_piece_size())])
        # "\n" + x: the library's space, the line feed's byte, then x without a space before it
        if len(self.model.encode("\n")) != 2:
            raise ValueError("a line feed is not one byte token of its own")
        self.cache: dict[str, int] = {}

    def resolve(self, keys: list[str], table: dict[str, int]) -> list[int]:
        """Lengths of different ``keys``: from the table, the cache, else by encoding."""
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
        out = list(map(table.get, keys))
        out = [self.cache.get(k) if n is None else n for k, n in zip(keys, out, strict=True)]
        misses = [i for i, n in enumerate(out) if n is None]
        for i, n in zip(misses, self.lengths([keys[i] for i in misses]), strict=True):
            out[i] = n
            if len(keys[i]) <= _LONGEST_KEY:
                self.cache[keys[i]] = n
        return out

    def lengths(self, keys: list[str]) -> list[int]:
        return [len(ids) - 2 for ids in self.model.encode(["\n" + k for k in keys], num_threads=1)]

    def counts(self, texts: pa.Array | list[str], table: dict[str, int]) -> list[int]:
        split = Split(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        each = np.zeros(len(split.codes), np.int64)
        for where, before in ((split.spaced, " "), (split.bare, "")):
            codes, keys, _ = split.different(where, before)
            length = np.zeros(len(split.words), np.int64)
            length[codes] = self.resolve(keys, table)
            each[where] = length[split.codes[where]]
        of_lines = np.diff(np.concatenate([[0], np.cumsum(each)])[split.parts])
        keys = list({p for parts in split.odd_parts for p in parts})
        odd = dict(zip(keys, self.resolve(keys, table), strict=True))
        of_lines[split.odd] = [sum(map(odd.__getitem__, parts)) for parts in split.odd_parts]
        feeds = np.diff(split.lines) - 1
        return (np.diff(np.concatenate([[0], np.cumsum(of_lines)])[split.lines]) + feeds).tolist()


def _counter(path: str) -> PieceCounter:
    if path not in _worker:
        _worker[path] = PieceCounter(path)
    return _worker[path]


def _trim(c: Counter, keep: int) -> Counter:
    """Misra-Gries: keeps ``keep`` keys and takes the next count off each."""
    if len(c) <= keep:
        return c
    top = c.most_common(keep + 1)
    floor = top[-1][1]
    return Counter({k: n - floor for k, n in top[:-1] if n > floor})


def _runs(column: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Runs of a binary column of about ``RUN_BYTES`` each as texts, with the place of their
    first; null becomes empty, bytes that are no UTF-8 the replacement character."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        held += n
        if held >= RUN_BYTES or i == len(sizes) - 1:
            part = column.slice(start, i + 1 - start)
            try:
                yield start, pc.fill_null(part.cast(pa.string()), "")
            except pa.ArrowInvalid:
                yield start, pa.array([(t or b"").decode("utf-8", "replace") for t in part.to_pylist()], pa.string())
            start, held = i + 1, 0


def frequent_pre_tokens(docs: DataFrame, table_size: int = TABLE_SIZE) -> list[str]:
    """The corpus's frequent pre-tokens, at most ``table_size``, from summaries, as large as that,
    of every task's whole input merged in a tree of fan-in ``FAN_IN``."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for b in batches:
            for _, texts in _runs(b.column("text")):
                for k, n in Split(texts).pre_tokens():
                    if len(k) <= _LONGEST_KEY:
                        found[k] += n
                if len(found) > 16 * table_size:
                    found = _trim(found, 8 * table_size)
        found = _trim(found, table_size)
        if found:
            yield pa.RecordBatch.from_pydict({"keys": [list(found)], "ns": [list(found.values())]},
                                             schema=pa.schema([("keys", pa.list_(pa.string())), ("ns", pa.list_(pa.int64()))]))

    parts = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(summarise, "keys array<string>, ns array<bigint>")
    rdd = parts.rdd.map(lambda r: Counter(dict(zip(r[0], r[1], strict=True))))
    if not rdd.getNumPartitions():
        return []
    depth = max(1, math.ceil(math.log(rdd.getNumPartitions(), FAN_IN)))
    merged = rdd.treeAggregate(Counter(), lambda a, b: _trim(a + b, table_size), lambda a, b: _trim(a + b, table_size), depth)
    return [k for k, _ in sorted(merged.items(), key=lambda x: (-x[1], x[0]))]


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096, table_size: int = TABLE_SIZE,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of every row of ``docs``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    frequent = frequent_pre_tokens(rows, table_size)
    ruler = PieceCounter(model_path)
    table = spark.sparkContext.broadcast(dict(zip(frequent, ruler.lengths(frequent), strict=True)))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counter = table.value, _counter(model_path)
        for b in batches:
            for at, texts in _runs(b.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(at, len(texts)).cast(pa.int64()),
                     b.column("n_bytes").slice(at, len(texts)).cast(pa.int64()),
                     pa.array(counter.counts(texts, known), pa.int64())], schema=schema)

    sized = rows.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), F.col("text").cast("binary").alias("text"))
    return (sized.mapInArrow(measure, "doc_id bigint, n_bytes bigint, n_tokens bigint")
            .withColumn("over_limit", F.col("n_tokens") > limit))
