"""Packing documents into sequences of a fixed number of tokens by minimum bin slack.

Lengths are whole numbers from 1 to the capacity, so all a plan needs is how many pieces
have each length: at most ``capacity`` counts, whatever the corpus. The heuristic fills
one bin at a time. Its longest remaining piece goes in; a subset-sum dynamic programme
over the available lengths, its reachable sums the bits of one integer, then finds the
fullest feasible combination for the rest, which is removed. The same combination is the
answer again while its lengths last, so it is taken as often as they do.

Spark does the work on pieces: tokenise (no shuffle), count pieces per task and length,
number the pieces of each length (a task's own number plus the counts of the tasks
before), and look each number up in the plan, which has a few thousand intervals.

Defined results: a null text is an empty one (the end id alone); every row is packed,
repeated rows too; a very long text is tokenised whole and cut into pieces of the capacity;
which of several pieces of one length goes where is left open; an empty table gives an empty
result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from canopus.session import cut_lineage

from .word_ids import word_ids

CAPACITY = 4096


def fullest(available: dict[int, int], room: int) -> dict[int, int]:
    """The combination of available lengths with the largest sum up to ``room``: how often
    each is taken. Long lengths come first, so short ones are kept for later bins."""
    mask = (1 << (room + 1)) - 1
    goal = 1 << room
    reach, steps = 1, []
    for length in sorted((x for x in available if x <= room), reverse=True):
        steps.append((length, reach))
        left, part = min(available[length], room // length), 1
        while left and not reach & goal:
            part = min(part, left)
            reach |= (reach << (length * part)) & mask
            left -= part
            part *= 2
        if reach & goal:
            break
    total, taken = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        n = 0
        while not before >> total & 1:   # reachable without this length from here on?
            total -= length
            n += 1
        if n:
            taken[length] = n
    return taken


def minimum_bin_slack(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Bins as ``(times, [(length, how often in each bin), ...])`` that use up ``counts``."""
    left = {k: n for k, n in counts.items() if n}
    plan = []
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        if not rest[longest]:
            del rest[longest]
        taken = fullest(rest, capacity - longest)
        taken[longest] = taken.get(longest, 0) + 1
        times = min(left[k] // n for k, n in taken.items())
        plan.append((times, sorted(taken.items(), reverse=True)))
        for k, n in taken.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return plan


def intervals(plan: list[tuple[int, list[tuple[int, int]]]]) -> dict[str, np.ndarray]:
    """The plan by (length, number within the length): sorted starts, and for each the first
    bin, pieces of the length in a bin, and the place of the first of them."""
    used: dict[int, int] = {}
    rows, first_bin = [], 0
    for times, items in plan:
        place = 0
        for length, n in items:
            at = used.get(length, 0)
            rows.append((length, at, first_bin, n, place))
            used[length] = at + n * times
            place += length * n
        first_bin += times
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "at", "bin", "each", "place"), cols, strict=True))


def last_start(plan: dict[str, np.ndarray], length: np.ndarray, number: np.ndarray) -> np.ndarray:
    """The interval of each length with the largest start up to the number. Starts are below
    ``edge``, so one sorted key serves all lengths; numbers beyond lie in the last interval."""
    edge = int(plan["at"].max(initial=0)) + 1
    keys = plan["length"] * edge + plan["at"]
    return np.searchsorted(keys, length * edge + np.minimum(number, edge - 1), "right") - 1


def pieces_of(docs: DataFrame, vocabulary: str, end_id: int, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """Every piece with its task and its number among the task's pieces of its length."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    end = np.array([end_id], "<u4").tobytes()
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64()), ("task", pa.int64()), ("number", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = word_ids(vocabulary), TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for b in batches:
            ids = b.column("doc_id").to_pylist()
            for at, part in encoder.runs(b.column("text")):
                out: list[list] = [[] for _ in schema]
                for key, data in zip(ids[at : at + len(part)], part, strict=True):
                    data += end
                    for k in range(0, len(data), 4 * capacity):
                        piece = data[k : k + 4 * capacity]
                        n = len(piece) // 4
                        for col, v in zip(out, (key, k // (4 * capacity), k // 4, n, zlib.crc32(piece), task, seen[n]), strict=True):
                            col.append(v)
                        seen[n] += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    return rows.mapInArrow(cut, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task bigint, number bigint")


def pack(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` per piece. Only
    documents longer than ``capacity`` are cut, into pieces of it; the last may be shorter."""
    spark = docs.sparkSession
    pieces = cut_lineage(pieces_of(docs, vocabulary, end_id, capacity, id_col, text_col), "pieces")
    counts = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")   # a row per task
    counts = cut_lineage(counts.select("task", "length", "n", before.alias("before")), "piece_counts")
    lengths = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}   # at most ``capacity`` rows
    plan = spark.sparkContext.broadcast(intervals(minimum_bin_slack(lengths, capacity)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = plan.value
        for b in batches:
            length, number = (b.column(c).to_numpy() for c in ("length", "rank"))
            k = last_start(p, length, number)
            slot = number - p["at"][k]
            bins = p["bin"][k] + slot // p["each"][k]
            offset = p["place"][k] + slot % p["each"][k] * length
            cols = [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(bins), pa.array(offset)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    # a merge join: the counts grow with the tasks, so they are no table to broadcast
    ranked = pieces.join(counts.select("task", "length", "before").hint("merge"), ["task", "length"])
    return ranked.withColumn("rank", F.col("before") + F.col("number")).mapInArrow(
        place, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
