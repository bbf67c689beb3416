"""Token ids in binary files of patched frame-of-reference segments (:mod:`.pfor`).

``write_token_ids`` sorts the documents by id with a range partitioning, encodes each
partition in order and writes one file per segment, so files have a bounded size. They
are written by Spark's own writer (each row's bytes as they are), which reaches any file
system Spark does and commits a task's files only once, whichever attempt wins.
``read_token_ids`` decodes the files with Spark's binary reader.

Defined results: a null text is an empty one (its ids are the end id alone); a null id
sorts first; equal ids sort by the hash of their text, equal rows in any order, as they
are the same; a very long text is encoded whole; repeated rows are written each; an empty
table writes no segment and reads as no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from canopus.session import cut_lineage, new_folder

from . import pfor
from .word_ids import word_ids

#: Ids in a segment at least (but for a partition's last): a file has at most these and one document more.
SEGMENT_IDS = 1 << 21


def write_token_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int, percentile: float = pfor.PERCENTILE,
                    segment_ids: int = SEGMENT_IDS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the ids of all documents, each with ``end_id`` after it, in ascending id order."""
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
            .withColumn("h", F.xxhash64("text"))
            .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("h"))
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "h")
            .select("doc_id", "text"))
    end = np.array([end_id], "<u4").tobytes()

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(vocabulary)
        partition = TaskContext.get().partitionId()
        held: list[bytes] = []
        keys: list[int | None] = []
        size = before = sequence = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, keys, size, before, sequence
            data = pfor.encode(np.frombuffer(b"".join(held), "<u4"), np.array([k or 0 for k in keys], np.int64),
                               np.array([k is None for k in keys]), np.array([len(x) // 4 for x in held], np.uint32),
                               partition, sequence, before, percentile)
            held, keys, size, before, sequence = [], [], 0, before + size, sequence + 1
            return pa.RecordBatch.from_pydict({"segment": [data]}, schema=pa.schema([("segment", pa.binary())]))

        for b in batches:
            ids = b.column("doc_id").to_pylist()
            for at, part in encoder.runs(b.column("text")):
                for key, data in zip(ids[at : at + len(part)], part, strict=True):
                    held.append(data + end)
                    keys.append(key)
                    size += len(held[-1]) // 4
                    if size >= segment_ids:
                        yield flush()
        if held:
            yield flush()

    (rows.mapInArrow(segments, "segment binary").select(F.col("segment").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", 1).option("compression", "none").text(path))


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` per document, from the files alone: the ids
    before it over all files, its ids and their checksum."""
    schema = pa.schema([("partition", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64())])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column("content"):
                data = content.as_buffer()
                if data is None or data.size < pfor.HEADER.size:
                    continue
                s = pfor.decode(data)
                ids = memoryview(s.ids().astype("<u4")).cast("B")
                ends = np.cumsum(s.lengths.astype(np.int64))
                starts = ends - s.lengths
                sums = [zlib.crc32(ids[4 * a : 4 * e]) for a, e in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ends), s.partition)), pa.array(s.doc_ids, mask=s.nulls.astype(bool)),
                     pa.array(starts + s.before), pa.array(s.lengths.astype(np.int64)), pa.array(sums, pa.int64())], schema=schema)

    # one file a row: a batch of a few, as each may be megabytes
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    rows = cut_lineage(files.mapInArrow(documents, "partition bigint, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint"),
                       "token_rows")
    # one row per written partition: a small table whatever the corpus
    totals = rows.groupBy("partition").agg(F.sum("n_tokens").alias("ids"))
    base = totals.select("partition", (F.sum("ids").over(Window.orderBy("partition")) - F.col("ids")).alias("base"))
    return (rows.join(F.broadcast(base), "partition")
            .select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"))


def token_output(docs: DataFrame, vocabulary: str, end_id: int, path: str | None = None, **options) -> DataFrame:
    """Writes the files (to a new folder beside the checkpoints if ``path`` is unset) and reads them back."""
    spark = docs.sparkSession
    path = path or new_folder(spark, "token_ids")
    write_token_ids(docs, path, vocabulary, end_id, **options)
    return read_token_ids(spark, path)
