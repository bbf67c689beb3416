"""N-gram generation with a log-likelihood-ratio filter (A4).

For every gram size n in 2..max_ngram, n-grams are built from the ordered, filtered tag
list of each document. For each n-gram (head = leading n-1 tags, tail = last tag):
  k11 = count(gram), k12 = count(head as head) - k11, k21 = count(tail as tail) - k11,
  k22 = T - k11 - k12 - k21 with T the number of n-grams of that size.
A gram is kept when k11 >= min_support and G^2 >= min_llr. Unigrams are not tested.

Most grams are rarer than min_support, so they are sieved before any of them is shuffled. A first pass
counts 32-bit hashes of all grams of sizes 1..max_ngram: sorted runs of two or three bytes a gram, added up
by range of the hash. A hash counts at least what each of its grams does; those that reach min_support are
a bitmap of bounded size (:class:`Bits`). A second pass counts, by their strings and so exactly, the grams,
heads and tails that the bitmap lets through.

The accepted grams then choose occurrences (:func:`gram_finder`) by a second bitmap beside the first; the few
grams that both let through wrongly are among those counted by their strings, so they are listed and left
out by name. :func:`ngram_tokens` gives the occurrences as rows instead, by a broadcast of the accepted
grams if they are few (measured bytes), else by a join behind a Bloom filter of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopus.functions.llr import llr
from canopus.operators.ranking import BROADCAST_BYTES, broadcast_if_small, lookup_join
from canopus.session import cut_lineage

#: Grams to a 64-bit word of the filter, bits that each sets, and the largest number of words (64 MB
#: broadcast, 8 million grams). More grams fill the words and let more through; the join stays exact.
GRAMS_A_WORD, GRAM_BITS, MAX_WORDS = 8, 4, 1 << 20


def _grams(tags: Column, n: int) -> Column:
    starts = F.when(F.size(tags) >= n, F.sequence(F.lit(0), F.size(tags) - n)).otherwise(
        F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(
        F.lit(n).alias("n"),
        F.array_join(F.slice(tags, i + 1, n), " ").alias("gram"),
        F.array_join(F.slice(tags, i + 1, n - 1), " ").alias("head"),
        F.element_at(tags, i + n).alias("tail")))


def ngram_occurrences(tag_docs: DataFrame, first: int, last: int) -> DataFrame:
    """``(doc_id, n, gram, head, tail)``, one row per occurrence of an n-gram of a size in
    ``first..last``."""
    grams = F.concat(*(_grams(F.col("tags"), n) for n in range(first, last + 1)))
    return (tag_docs.select("doc_id", F.explode_outer(grams).alias("g")).where(F.col("g").isNotNull())
            .select("doc_id", "g.*"))


# ----------------------------------------------------------------------------- hashes of grams

RUN_TAGS = 250_000   # tags whose grams a task looks at at once, whole documents
BASE = 0x9E3779B97F4A7C15   # odd: the hash of a string is the sum of (byte + 1) * BASE ** place, modulo 2 ** 64
SPACE = np.uint64(ord(" ") + 1)


def _powers(n: int, base: int) -> np.ndarray:
    """``base ** j`` for j < n."""
    return np.multiply.accumulate(np.append(np.uint64(1), np.full(n - 1, base, np.uint64)))


def string_hashes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each string without nulls and BASE to its length, so that hashes of joined strings
    follow from those of their parts."""
    strings = strings.cast(pa.large_string())
    ends = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset:strings.offset + len(strings) + 1]
    if not len(strings) or ends[-1] == ends[0]:
        return np.zeros(len(strings), np.uint64), np.ones(len(strings), np.uint64)
    data = np.frombuffer(strings.buffers()[2], np.uint8)[ends[0]:ends[-1]]
    ends = ends - ends[0]
    power = _powers(len(data) + 1, BASE)
    upto = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1], out=upto[1:])
    h, length = upto[ends[1:]] - upto[ends[:-1]], power[np.diff(ends)]
    del upto, power
    return h * _powers(len(data) + 1, pow(BASE, -1, 1 << 64))[ends[:-1]], length


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _sieved(h: np.ndarray) -> np.ndarray:
    """The 32-bit hashes of the sieve."""
    return (_mixed(h) >> np.uint64(32)).astype(np.uint32)


def _chosen(h: np.ndarray) -> list[np.ndarray]:
    """The 32-bit hashes of the accepted grams' bitmap, two of each gram."""
    return [_mixed(h).astype(np.uint32), _mixed(h + SPACE).astype(np.uint32)]


def tag_runs(batch: pa.RecordBatch, most: int, column: str = "tags") -> Iterator[pa.RecordBatch]:
    """Runs of whole documents with about ``most`` tags (or ``terms``). What a run took is given back after it."""
    lens = pc.fill_null(pc.list_value_length(batch.column(column)), 0).to_numpy()
    edges = np.flatnonzero(np.diff(np.cumsum(lens) // most, prepend=0)).tolist()
    for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
        yield batch.slice(a, b - a)
        pa.default_memory_pool().release_unused()


class TagRun:
    """The tags of a run of documents one after the other, as codes of its ``words``; the last two are
    those of a missing and an empty tag. ``row`` is each tag's document."""

    def __init__(self, batch: pa.RecordBatch):
        tags = batch.column("tags")
        flat = pc.list_flatten(tags)
        coded = flat.dictionary_encode()
        self.row = pc.list_parent_indices(tags).to_numpy()
        self.words = pa.concat_arrays([coded.dictionary, pa.array([None, ""], coded.dictionary.type)])
        self.code = pc.fill_null(coded.indices, len(coded.dictionary)).to_numpy().astype(np.int64)
        h, w = string_hashes(coded.dictionary)
        self.h, self.w = np.append(h, np.uint64(0))[self.code], np.append(w, np.uint64(1))[self.code]
        self.missing = self.code == len(coded.dictionary) if flat.null_count else None
        # of each tag: hash of the tags joined so far, BASE to its length, and whether there is one yet
        self.joined, self.length, self.some = self.h, self.w, None if self.missing is None else ~self.missing
        self.n = 1

    def longer(self) -> np.ndarray:
        """Goes on to windows of one more tag, by their first tags: ``at``. ``scored`` is the hash of
        head, space and tail, ``joined`` that of the present tags with spaces."""
        self.n += 1
        keep = self.row[self.n - 1:] == self.row[:len(self.row) - self.n + 1] if len(self.row) >= self.n else np.zeros(0, bool)
        if self.n == 2:
            self.at, old = np.flatnonzero(keep), slice(0, len(keep))
            self.joined, self.length = self.joined[old][keep], self.length[old][keep]
            self.some = None if self.some is None else self.some[old][keep]
        else:
            still = keep[np.minimum(self.at, max(0, len(keep) - 1))] & (self.at < len(keep)) if len(keep) else np.zeros(len(self.at), bool)
            self.at, self.joined, self.length = self.at[still], self.joined[still], self.length[still]
            self.some = None if self.some is None else self.some[still]
        self.heads = self.joined
        last = self.at + self.n - 1
        h, w, step = self.h[last], self.w[last], self.length * np.uint64(BASE)
        self.scored = self.joined + SPACE * self.length + h * step
        if self.some is None:
            self.joined, self.length = self.scored, step * w
        else:
            gone = self.missing[last]
            self.joined = np.where(gone, self.joined, np.where(self.some, self.scored, h))
            self.length = np.where(gone, self.length, np.where(self.some, step * w, w))
            self.some = self.some | ~gone
        return self.at

    def followed(self, at: np.ndarray, n: int) -> np.ndarray:
        """1 for the windows of ``n`` tags at ``at`` that another tag follows, 0 for others."""
        after = np.minimum(at + n, len(self.row) - 1)
        return ((at + n == after) & (self.row[after] == self.row[at])).astype(np.int64)

    def distinct(self, at: np.ndarray, n: int, and_: np.ndarray | None = None, counts: bool = True) -> tuple[list[np.ndarray], np.ndarray]:
        """The different windows of ``n`` tags that start at ``at``, as codes (and what they have in ``and_``),
        with their numbers (or the place of each window of ``at`` among them)."""
        bits = len(self.words).bit_length()
        cols = [*(self.code[at + k] for k in range(n)), *([] if and_ is None else [and_])]
        n = len(cols)
        if n * bits <= 63:
            key, more = np.unique(reduce(lambda k, c: (k << bits) | c, cols), **{"return_counts" if counts else "return_inverse": True})
            return [(key >> (bits * (n - 1 - k))) & ((1 << bits) - 1) for k in range(n)], more
        order = np.lexsort(cols)
        new = np.append(True, reduce(np.logical_or, (np.diff(c[order]) != 0 for c in cols))) if len(at) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        if counts:
            return [c[order[first]] for c in cols], np.diff(np.append(first, len(order)))
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(new) - 1
        return [c[order[first]] for c in cols], place

    def strings(self, cols: list[np.ndarray]) -> pa.Array:
        """Windows' present tags with spaces."""
        none = reduce(np.logical_and, (c == len(self.words) - 2 for c in cols))
        if none.any():   # Arrow would give fewer strings
            cols = [np.where(none, len(self.words) - 1, cols[0]), *cols[1:]]
        return pc.binary_join_element_wise(*(self.words.take(pa.array(c)) for c in cols), " ", null_handling="skip")


def _tag_run(batch: pa.RecordBatch) -> TagRun | None:
    run = TagRun(batch)
    return run if len(run.code) else None


# ----------------------------------------------------------------------------- bitmaps of hashes

PARTS = 512                # ranges of the 32-bit hashes, by their leading bits
PART_BITS = 23             # 32 less the bits that tell ranges apart
ROOM, MAX_BITS = 32, 28    # bits of a bitmap for each hash, and the power of two of all its bits (32 MB) at most


@dataclass
class Bits:
    """A set of 32-bit hashes, by their leading ``power`` bits; others that share these are in it too."""
    data: np.ndarray
    power: int

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h >> np.uint32(32 - self.power)
        return (self.data[at >> np.uint32(3)] >> (at & np.uint32(7)).astype(np.uint8)) & np.uint8(1) != 0


def _parts(h: np.ndarray, cap: int) -> Iterator[pa.RecordBatch]:
    """Hashes sorted, with how many there are of each, up to ``cap``: a row ``(part, gaps, counts)`` a range."""
    h = np.sort(h)
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
    n = np.minimum(np.diff(np.append(first, len(h))), cap).astype(np.uint8)
    h = h[first]
    cuts = np.searchsorted(h, np.arange(PARTS + 1, dtype=np.uint64) << np.uint64(PART_BITS)).tolist()
    rows = []
    for part in range(PARTS):
        own = slice(cuts[part], cuts[part + 1])
        if own.stop > own.start:
            gaps = np.diff(h[own] & np.uint32((1 << PART_BITS) - 1), prepend=np.uint32(0))
            rows.append((part, gaps.astype("<u2" if gaps.max() < 1 << 16 else "<u4").tobytes(), n[own].tobytes()))
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["part", "gaps", "counts"])


def _adder(least: int):
    """Ranges in order, some rows each: their hashes that there are ``least`` of, as numbers of 4 bytes."""
    def run(batches):
        part, total, found = None, None, []

        def out():
            all_ = np.concatenate(found)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([len(all_)], pa.int64()), pa.array([all_.tobytes()], pa.binary())], names=["part", "n", "found"])

        for batch in batches:
            for p, gaps, counts in zip(batch.column("part").to_pylist(), batch.column("gaps"), batch.column("counts"), strict=True):
                if p != part:
                    if part is not None:
                        yield out()
                    part, total, found = p, np.zeros(1 << PART_BITS, np.uint8), []
                counts = np.frombuffer(counts.as_buffer(), np.uint8)
                gaps = gaps.as_buffer()
                at = np.cumsum(np.frombuffer(gaps, "<u2" if len(gaps) == 2 * len(counts) else "<u4"), dtype=np.int64)
                old = total[at]
                total[at] = new = np.minimum(old + counts.astype(np.uint16), least).astype(np.uint8)
                found.append(at[(new == least) & (old < least)].astype("<u4"))   # once a hash
        if part is not None:
            yield out()
    return run


def _bit_slices(power: int):
    def run(batches):
        for batch in batches:
            for p, found in zip(batch.column("part").to_pylist(), batch.column("found"), strict=True):
                bits = np.zeros(1 << (power + PART_BITS - 32), bool)
                bits[np.frombuffer(found.as_buffer(), "<u4") >> np.uint32(32 - power)] = True
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], names=["part", "bits"])
    return run


def bits_of(parts: DataFrame, least: int = 1, most: int = MAX_BITS) -> Bits:
    """The hashes that there are ``least`` of in rows of :func:`_parts`. The bitmap alone reaches the driver."""
    found = cut_lineage(parts.repartition("part").sortWithinPartitions("part")
                        .mapInArrow(_adder(least), "part int, n long, found binary"), "gram_hashes")
    n = found.agg(F.sum("n").alias("n")).first()["n"] or 0
    power = max(32 - PART_BITS + 3, min(most, (n * ROOM).bit_length()))
    data = np.zeros(1 << (power - 3), np.uint8)
    per = len(data) // PARTS
    for r in found.select("part", "found").mapInArrow(_bit_slices(power), "part int, bits binary").toLocalIterator():   # PARTS rows
        data[r["part"] * per:(r["part"] + 1) * per] = np.frombuffer(r["bits"], np.uint8)
    return Bits(data, power)


MAX_COUNT = 200   # that the sieve tells apart; more frequent hashes count as so many


def _all_hashes(last: int, least: int):
    def run(batches):
        for whole in batches:
            for batch in tag_runs(whole, RUN_TAGS):
                if (tags := _tag_run(batch)) is None:
                    continue
                h = [_sieved(tags.joined)]
                for _ in range(2, last + 1):
                    tags.longer()
                    h.append(_sieved(tags.joined))
                    if tags.missing is not None:   # what is scored may be another string then
                        h.append(_sieved(tags.scored[tags.scored != tags.joined]))
                yield from _parts(np.concatenate(h), least)
    return run


def frequent_hashes(tag_docs: DataFrame, last: int, min_count: int) -> Bits:
    """The sieve: hashes of all tags and grams up to size ``last`` that occur ``min_count`` times."""
    least = min(min_count, MAX_COUNT)
    return bits_of(tag_docs.select("tags").mapInArrow(_all_hashes(last, least), "part int, gaps binary, counts binary"), least)


# ----------------------------------------------------------------------------- counts

GRAM, HEAD, TAIL, OTHER, TOTAL = range(5)   # OTHER: windows with missing tags, as joined
COUNTED = "kind int, n int, head string, tail string, k11 long, followed long"


def _count_grams(sieve, first: int, last: int):
    """Counts of a run's grams, heads and tails that pass the sieve, and of all its windows. A gram that
    another tag follows is a head of the next size, so heads of more than one tag need no rows of their own
    (but for tags that are missing, which leave no trace in the head)."""
    def passed(h):
        return np.ones(len(h), bool) if sieve is None else sieve.value.has(_sieved(h))

    def rows(kind, n, head, tail, count, followed=0):
        m = len(count)
        count = np.asarray(count, np.int64)
        none = pa.nulls(m, pa.string())
        return pa.RecordBatch.from_arrays([pa.array(np.full(m, kind, np.int32)), pa.array(np.full(m, n, np.int32)), none if head is None else head.cast(pa.string()),
                                           none if tail is None else tail.cast(pa.string()), pa.array(count), pa.array(count * followed)], names=["kind", "n", "head", "tail", "k11", "followed"])

    def run(batches):
        for all_ in batches:
            for batch in tag_runs(all_, RUN_TAGS):
                if (tags := _tag_run(batch)) is None:
                    continue
                one = passed(tags.h)   # by tag: passes as a head or tail of one tag
                for n in range(2, last + 1):
                    at = tags.longer()
                    if n < first or not len(at):
                        continue
                    yield rows(TOTAL, n, None, None, [len(at)])
                    own, whole = at[passed(tags.scored)], tags.missing is None
                    cols, count = tags.distinct(own, n, tags.followed(own, n) if whole and n < last else None)
                    yield rows(GRAM, n, tags.strings(cols[:n - 1]), tags.words.take(pa.array(cols[n - 1])), count, cols[n] if len(cols) > n else 0)
                    if not whole or n == max(2, first):
                        cols, count = tags.distinct(at[one[at] if n == 2 else passed(tags.heads)], n - 1)
                        yield rows(HEAD, n, tags.strings(cols), None, count)
                    end = at + n - 1
                    end = end[one[end]] if tags.missing is None else end[one[end] & ~tags.missing[end]]
                    cols, count = tags.distinct(end, 1)
                    yield rows(TAIL, n, None, tags.words.take(pa.array(cols[0])), count)
                    if tags.missing is not None:
                        cols, count = tags.distinct(at[(tags.scored != tags.joined) & passed(tags.joined)], n)
                        yield rows(OTHER, n, tags.strings(cols), None, count)
    return run


def gram_counts(tag_docs: DataFrame, first: int, last: int, sieve: Bits | None = None) -> DataFrame:
    """``(kind, n, head, tail, k11)``, written: the exact counts of grams, heads and tails of the sizes
    ``first..last`` that pass the sieve, and the number of all windows of a size."""
    shared = None if sieve is None else tag_docs.sparkSession.sparkContext.broadcast(sieve)
    parts = tag_docs.select("tags").mapInArrow(_count_grams(shared, first, last), COUNTED)
    return cut_lineage(parts.groupBy("kind", "n", "head", "tail").agg(F.sum("k11").alias("k11"), F.sum("followed").alias("followed")), "ngrams")


def llr_scores(tag_docs: DataFrame, first: int = 2, last: int | None = None, min_count: int = 1) -> DataFrame:
    """``(n, gram, head, tail, k11, k12, k21, k22, llr)`` for every distinct n-gram of the
    sizes ``first..last`` (of ``first`` alone by default) that occurs ``min_count`` times."""
    tag_docs = cut_lineage(tag_docs.select("tags"), "ngram_tags")   # parsed once
    last = last or first
    sieve = frequent_hashes(tag_docs, last, min_count) if min_count > 1 else None
    return _scores(gram_counts(tag_docs, first, last, sieve), min_count)


def _scores(counted: DataFrame, min_count: int) -> DataFrame:
    """:func:`llr_scores` of :func:`gram_counts`."""
    grams = counted.where(F.col("kind") == GRAM).select("n", "head", "tail", "k11")
    one_tag = counted.where(F.col("kind") == HEAD).select("n", "head", F.col("k11").alias("head_n"))
    more = counted.where((F.col("kind") == GRAM) & (F.col("followed") > 0)).select((F.col("n") + 1).alias("n"), F.concat_ws(" ", "head", "tail").alias("head"), F.col("followed").alias("head_n"))
    heads = one_tag.unionByName(more).groupBy("n", "head").agg(F.sum("head_n").alias("head_n"))
    heads = cut_lineage(heads.where(F.col("head_n") >= min_count), "ngram_heads")
    tails = cut_lineage(counted.where((F.col("kind") == TAIL) & (F.col("k11") >= min_count)).select("n", "tail", F.col("k11").alias("tail_n")), "ngram_tails")
    totals = counted.where(F.col("kind") == TOTAL).select("n", F.col("k11").alias("total"))   # one row a size
    if min_count > 1:   # a gram's head and tail are as frequent as itself at least
        grams = cut_lineage(grams.where(F.col("k11") >= min_count), "ngrams_frequent")
    scored = lookup_join(grams, heads, ["n", "head"], F.col("head_n"))
    scored = lookup_join(scored, tails, ["n", "tail"], F.col("tail_n")).join(F.broadcast(totals), "n")
    k11 = F.col("k11")
    k12 = F.col("head_n") - k11
    k21 = F.col("tail_n") - k11
    k22 = F.col("total") - k11 - k12 - k21
    scored = scored.select("n", F.concat_ws(" ", "head", "tail").alias("gram"), "head", "tail", k11.alias("k11"), k12.alias("k12"),
                           k21.alias("k21"), k22.alias("k22"), F.array(llr(k11, k12, k21, k22)).alias("_llr"))
    # above a generator: else a filter on the ratio is evaluated below the projection, term by term
    return scored.select(*scored.columns[:-1], F.explode_outer("_llr").alias("llr"))


def _accepted(scores: DataFrame, min_support: int, min_llr: float) -> DataFrame:
    return (scores.where((F.col("k11") >= min_support) & (F.col("llr") >= min_llr))
            .select("gram", "n", "k11", "llr"))


def accepted_ngrams(tag_docs: DataFrame, max_ngram: int, min_support: int, min_llr: float) -> DataFrame:
    """``(gram, n, k11, llr)`` of all sizes 2..max_ngram passing both filters."""
    return _accepted(llr_scores(tag_docs, 2, max_ngram, min_support), min_support, min_llr)


def _word_and_mask(gram: Column, n_words: int) -> tuple[Column, Column]:
    """The filter's word of a gram and the bits that it sets there."""
    mask = F.lit(0).cast("long")
    bits = F.xxhash64(gram, F.lit("bits"))
    for k in range(GRAM_BITS):
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(bits, 6 * k).bitwiseAND(F.lit(63)).cast("int")))
    return F.pmod(F.xxhash64(gram), F.lit(n_words)), mask


def gram_filter(kept: DataFrame) -> tuple[DataFrame, int]:
    """A Bloom filter of ``kept.gram`` as rows ``(word, bits)``, and its number of words."""
    n_words = 1
    while n_words < MAX_WORDS and n_words * GRAMS_A_WORD < kept.count():
        n_words *= 2
    word, mask = _word_and_mask(F.col("gram"), n_words)
    return cut_lineage(kept.select(word.alias("word"), mask.alias("mask"))
                       .groupBy("word").agg(F.bit_or("mask").alias("bits")), "ngram_filter"), n_words


def may_be_kept(occ: DataFrame, kept: DataFrame) -> DataFrame:
    """Occurrences whose gram is in ``kept``, and the few others that its Bloom filter lets through."""
    bits, n_words = gram_filter(kept)
    word, mask = _word_and_mask(F.col("gram"), n_words)
    return (occ.withColumn("_word", word).join(F.broadcast(bits), F.col("_word") == F.col("word"))
            .where(F.col("bits").bitwiseAND(mask) == mask).select(*occ.columns))


def ngram_tokens(tag_docs: DataFrame, max_ngram: int, min_support: int, min_llr: float,
                 broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``(doc_id, term, tf)`` of the accepted n-grams (sizes >= 2). ``tag_docs`` is read twice and
    should be a written table."""
    kept = cut_lineage(accepted_ngrams(tag_docs, max_ngram, min_support, min_llr).select("gram").distinct(), "ngrams_kept")
    occ = ngram_occurrences(tag_docs, 2, max_ngram).select("doc_id", "gram")
    known = broadcast_if_small(kept, broadcast_bytes)
    if known is kept:   # too large: a hot gram is added up per document before the join
        occ = may_be_kept(occ, kept)
    counted = occ.groupBy("doc_id", "gram").agg(F.count("*").alias("tf"))
    hits = counted if known is kept else occ.withColumn("tf", F.lit(1).cast("long"))
    return hits.join(known, "gram", "left_semi").select("doc_id", F.col("gram").alias("term"), "tf")


# ----------------------------------------------------------------------------- accepted grams, found in tasks

MAX_FALSE = 1_000_000   # grams that both bitmaps let through wrongly, at most: they are told to all tasks
ACCEPTED_BITS = 27      # power of two of the bits (16 MB) of the accepted grams' bitmap, at most


def _string_parts(batches):
    for batch in batches:
        yield from _parts(np.concatenate(_chosen(string_hashes(batch.column(0))[0])), 1)


def _may_be_accepted(h: np.ndarray, sieve, accepted) -> np.ndarray:
    ok = np.ones(len(h), bool) if sieve is None else sieve.value.has(_sieved(h))
    for two in _chosen(h):
        ok &= accepted.value.has(two)
    return ok


def _let_through(sieve, accepted):
    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(_may_be_accepted(string_hashes(batch.column(0))[0], sieve, accepted)))
    return run


@dataclass
class GramFinder:
    """What tasks need to tell accepted grams: broadcasts of the sieve, of the accepted grams' bitmap, and
    of those that these let through wrongly."""
    last: int
    sieve: object
    accepted: object
    wrong: object

    def find(self, tags: TagRun) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
        """For each size: the documents of accepted grams, a place for each occurrence, and the grams in
        ``strings`` there."""
        wrong = self.wrong.value
        for n in range(2, self.last + 1):
            at = tags.longer()
            at = at[_may_be_accepted(tags.joined, self.sieve, self.accepted)]
            if not len(at):
                continue
            cols, place = tags.distinct(at, n, counts=False)
            strings = tags.strings(cols)
            right = pc.invert(pc.is_in(strings, wrong)).to_numpy(zero_copy_only=False)[place]
            yield tags.row[at][right], place[right], strings


def gram_finder(tag_docs: DataFrame, max_ngram: int, min_support: int, min_llr: float) -> GramFinder | None:
    """Finds the accepted n-grams of documents. None if too many other grams look like them: then
    :func:`ngram_tokens` does. ``tag_docs`` is read twice and should be a written table."""
    shared = tag_docs.sparkSession.sparkContext.broadcast
    sieve = frequent_hashes(tag_docs, max_ngram, min_support) if min_support > 1 else None
    counted = gram_counts(tag_docs, 2, max_ngram, sieve)
    kept = cut_lineage(_accepted(_scores(counted, min_support), min_support, min_llr).select("gram").distinct(), "ngrams_kept")
    accepted = shared(bits_of(kept.mapInArrow(_string_parts, "part int, gaps binary, counts binary"), most=ACCEPTED_BITS))
    sieve = None if sieve is None else shared(sieve)
    seen = counted.where(F.col("kind") == GRAM).where(F.col("tail").isNotNull()).select(F.concat_ws(" ", "head", "tail").alias("gram")).unionByName(
        counted.where(F.col("kind") == OTHER).select(F.col("head").alias("gram")))
    wrong = cut_lineage(seen.mapInArrow(_let_through(sieve, accepted), "gram string").distinct().join(kept, "gram", "left_anti"), "ngrams_wrong")
    if wrong.count() > MAX_FALSE:
        return None
    return GramFinder(max_ngram, sieve, accepted, shared(pa.array(wrong.toArrow().column("gram").to_pylist(), pa.string())))
