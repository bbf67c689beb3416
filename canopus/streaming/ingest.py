"""Streaming form of the tag-file scan.

New tag-line files dropped into a folder are parsed with exactly the batch rules
(``parse_tag_lines`` is a stateless projection/filter, so it runs unchanged on a
streaming DataFrame) and appended to the tag-document stage table. Vectorisation and
clustering then run as batch jobs over that table. Exactly-once output comes from the
file sink's commit log under ``checkpoint``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from canopus.config import VectorizeConfig
from canopus.sources.tags import parse_tag_lines


def stream_tag_docs(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str,
                    cfg: VectorizeConfig = VectorizeConfig(), max_files_per_trigger: int | None = None,
                    available_now: bool = True) -> StreamingQuery:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    docs = parse_tag_lines(reader.load(in_dir), cfg)
    writer = (docs.writeStream.format("parquet").option("path", out_dir)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
