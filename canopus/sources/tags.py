"""Delimited tag-file scan (one record per line: ``id|tag1|...|tagN``).

Parsing rules of the original tool, applied with built-in column functions:
  * split on the literal separator; trailing empty fields vanish (Java ``split``),
    so trailing separators are stripped before Spark's ``split`` (which keeps them);
  * lines with fewer than ``min_fields`` fields (id included) are skipped;
  * tags are fields 1 .. n-2 - the last field is never used (``drop_last_field``);
  * tags are lower-cased (no trimming) and stop tags are removed by a *full* match;
  * a line whose tags are all removed is kept, with an empty tag list.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopus.config import VectorizeConfig
from canopus.functions.stopwords import spark_full_match, stop_charset, stop_pattern, stop_starts

# Whitespace class shared with the SQL oracle (same members in Java regex and RE2).
WHITESPACE = r"[ \t\n\x0B\f\r]+"


def read_tag_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines as ``value STRING`` (UTF-8, one record per line)."""
    return spark.read.text(path)


def documents_as_tag_lines(documents: DataFrame, sep: str = "|") -> DataFrame:
    """Render the ``documents`` table in the tag-line format: id, then every
    whitespace-separated word as a field."""
    return documents.select(
        F.concat(F.col("doc_id").cast("string"), F.lit(sep),
                 F.regexp_replace("text", WHITESPACE, sep.replace("\\", "\\\\").replace("$", "\\$")))
        .alias("value"))


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan that yields fewer partitions than the cluster has cores
    (a small file with few row groups); large inputs are left as scanned."""
    target = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


def parse_tag_lines(lines: DataFrame, cfg: VectorizeConfig = VectorizeConfig(), drop_short: bool = True) -> DataFrame:
    """``value`` lines -> ``(doc_id STRING, tags ARRAY<STRING>)``.

    The part after the id is lower-cased once as a whole string and split once; the
    field count comes from string lengths (no regex, no split).

    With ``drop_short=False`` lines below ``min_fields`` are kept with ``tags = NULL``
    instead of being filtered. Consumers that explode the tags (``explode_outer`` +
    a NOT NULL filter above the generator) then evaluate the parse exactly once:
    a row filter on a derived column would be pushed below the projection (and below
    an exchange) with the parse expressions inlined, i.e. computed twice.
    """
    sep, esc = cfg.sep, re.escape(cfg.sep)
    value = F.col("value")
    if len(sep) == 1:
        stripped = F.expr(f"TRIM(TRAILING '{sep.replace(chr(39), chr(39) * 2)}' FROM value)")
    else:
        stripped = F.regexp_replace(value, f"(?:{esc})+\\z", "")
    lines = lines.select(stripped.alias("_s"))
    s = F.col("_s")
    n_sep = ((F.length(s) - F.length(F.replace(s, F.lit(sep), F.lit("")))) / F.lit(len(sep))).cast("int")
    doc_id = F.substring_index(s, sep, 1)
    rest = F.expr(f"substr(_s, length(substring_index(_s, '{sep.replace(chr(39), chr(39) * 2)}', 1)) + {len(sep) + 1})")
    fields = F.split(F.lower(rest), esc)                       # fields 1 .. n-1
    # lower-casing can neither make nor break a separator of ASCII signs: n_sep is the number of fields then, and
    # they are split once (inside a WHEN Spark evaluates a repeated expression each time)
    n_fields = n_sep if sep.isascii() and not any(c.isalpha() for c in sep) else F.size(fields)
    keep = F.greatest(n_fields - (1 if cfg.drop_last_field else 0), F.lit(0))
    pattern = spark_full_match(stop_pattern(cfg.stop_terms, cfg.drop_years))
    charset = stop_charset(cfg.stop_terms, cfg.drop_years)
    starts = stop_starts(cfg.stop_terms, cfg.drop_years)

    def is_stop(t):
        if not charset:
            return (t == F.lit("")) & t.rlike(pattern)
        return F.substring(t, 1, 1).isin(starts) & (F.translate(t, charset, "") == F.lit("")) & t.rlike(pattern)

    tags = F.when(n_sep > 0, F.filter(F.slice(fields, 1, keep), lambda t: ~is_stop(t))).otherwise(
        F.array().cast("array<string>"))
    if drop_short:
        return lines.where(n_sep + 1 >= cfg.min_fields).select(doc_id.alias("doc_id"), tags.alias("tags"))
    return lines.select(doc_id.alias("doc_id"),
                        F.when(n_sep + 1 >= cfg.min_fields, tags).alias("tags"))


def tag_tokens(tag_docs: DataFrame) -> DataFrame:
    """Long form ``(doc_id, pos INT, tag)``; ``pos`` is the 0-based position in the
    filtered tag list."""
    return (tag_docs.select("doc_id", F.posexplode_outer("tags").alias("pos", "tag"))
            .where(F.col("pos").isNotNull()))


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


def documents_tag_docs(spark: SparkSession, sf_dir: str, cfg: VectorizeConfig = VectorizeConfig(),
                       drop_short: bool = False) -> DataFrame:
    """Tag documents parsed from the ``documents`` table rendered as tag lines
    (short lines carry NULL tags unless ``drop_short``)."""
    return parse_tag_lines(documents_as_tag_lines(spread(read_documents(spark, sf_dir)), cfg.sep), cfg, drop_short)
