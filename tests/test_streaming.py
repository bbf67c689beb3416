"""Streaming ingest gives the same tag documents as the batch scan."""

import os
import tempfile

from canopus.config import VectorizeConfig
from canopus.sources.tags import parse_tag_lines
from canopus.streaming.ingest import stream_tag_docs
from tests_support import documents_lines


def test_stream_equals_batch(spark):
    root = tempfile.mkdtemp(prefix="canopus-stream-")
    src = os.path.join(root, "in")
    lines = documents_lines(spark)
    lines.write.text(src)
    q = stream_tag_docs(spark, src, os.path.join(root, "out"), os.path.join(root, "ckpt"), VectorizeConfig())
    q.awaitTermination(120)
    got = spark.read.parquet(os.path.join(root, "out"))
    exp = parse_tag_lines(spark.read.text(src), VectorizeConfig())
    key = lambda df: sorted((r["doc_id"], tuple(r["tags"])) for r in df.collect())
    assert key(got) == key(exp) and len(key(got)) > 0
