"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

Features come from the URL alone: lengths, path depth, digit ratio, character entropy,
hyphens, parameter counts, and statistics of the host's suffix (its last two labels) among
all labelled URLs. The trees are trained on a bounded sample of labelled URLs (at most
about ``max_train`` rows), with Spark's own trainer; there a URL's own labels are left out
of its suffix's statistics, so that a suffix of this URL alone looks like an unseen one.

No table labels URLs, so :func:`seed_labels` makes the labels: a URL is bad if a part of
its host is on a short list of words of the kinds a blocklist has, good otherwise. Any
table ``(url, label)`` serves instead.

Defined results: a null URL or one without ``://`` has empty host and path, fits no rule
and gets the trees' verdict on empty features; a very long URL is judged whole; of rules that
fit, the longest wins; repeated rows are judged each; an empty
table gives an empty result; without both labels in the sample every unruled URL is
allowed; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopus.session import cut_lineage

from .common import ascii_lower, broadcast_if_small

#: (rule, verdict); fixed values of the contract.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: Parts of hosts that mark a labelled URL as bad.
BAD_WORDS = ("adult", "ads", "bets", "casino", "cheap", "gambling", "loan", "pills", "poker", "porn", "spam", "torrent", "track",
             "viagra", "warez", "xxx")
MAX_TRAIN = 20_000
FEATURES = ("url_length", "host_length", "path_length", "query_length", "depth", "host_labels", "digit_ratio", "entropy",
            "host_entropy", "hyphens", "parameters", "fragment", "suffix_log_count", "suffix_bad_rate")


def host_and_path(url: Column) -> tuple[Column, Column]:
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.when(has, ascii_lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))).otherwise("")
    path = F.when(has, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)).otherwise("")
    return host, path


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, said in sorted(rules, key=lambda r: len(r[0])):   # longer rules come later and win
        domain, slash, rest = text.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def entropy(text: Column) -> Column:
    """Bits per character."""
    chars = F.sort_array(F.filter(F.split(text, ""), lambda c: c != ""))
    n = F.size(chars)
    counts = F.transform(F.array_distinct(chars), lambda c: F.size(F.filter(chars, lambda x: x == c)).cast("double"))
    return F.when(n > 0, F.aggregate(counts, F.lit(0.0), lambda a, k: a - k / n * F.log2(k / n))).otherwise(0.0)


def lexical(urls: DataFrame) -> DataFrame:
    """``urls`` (with ``url``, ``host``, ``path``) with the features that need no statistics."""
    url = F.coalesce("url", F.lit(""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    count = lambda s, chars: F.length(s) - F.length(F.translate(s, chars, ""))
    return urls.select(
        *urls.columns, F.length(url).alias("url_length"), F.length("host").alias("host_length"), F.length("path").alias("path_length"),
        F.length(query).alias("query_length"), count(F.col("path"), "/").alias("depth"), (count(F.col("host"), ".") + 1).alias("host_labels"),
        (count(url, "0123456789") / F.greatest(F.length(url), F.lit(1))).alias("digit_ratio"), entropy(url).alias("entropy"),
        entropy(F.col("host")).alias("host_entropy"), count(F.col("host"), "-").alias("hyphens"),
        F.when(query == "", 0).otherwise(count(query, "&") + 1).alias("parameters"), F.col("url").contains("#").cast("int").alias("has_fragment"),
        suffix_of(F.col("host")).alias("suffix")).withColumn("fragment", F.coalesce("has_fragment", F.lit(0))).drop("has_fragment")


def seed_labels(urls: DataFrame, words: Sequence[str] = BAD_WORDS) -> DataFrame:
    """``(url, label)``: 1 if a part of the host (between dots and hyphens) is on the list."""
    parts = F.split(host_and_path(F.col("url"))[0], r"[.\-]")
    return urls.where(F.col("url").contains("://")).select("url", F.arrays_overlap(parts, F.array(*map(F.lit, words))).cast("int").alias("label"))


def bounded_sample(df: DataFrame, most: int, seed: int = 3) -> DataFrame:
    """About ``most`` rows at most of ``df``, half of them of each ``label``, without a global sort;
    ``weight`` is how many rows one stands for, so that rare labels are all seen and count no
    more than they are. Rows are chosen by their place in the input, so a key that holds a third
    of them can't fill the sample beyond its share."""
    counts = {r["label"]: r["count"] for r in df.where(F.col("label").isNotNull()).groupBy("label").count().collect()}   # two labels
    share = F.lit(0.0)
    for label, n in counts.items():
        share = F.when(F.col("label") == label, F.lit(min(1.0, most / len(counts) / n))).otherwise(share)
    place = F.pmod(F.xxhash64(F.lit(seed), F.monotonically_increasing_id()), F.lit(1 << 20))
    return df.withColumn("weight", share).where(place < F.ceil(F.col("weight") * (1 << 20))).withColumn("weight", F.try_divide(F.lit(1.0), F.col("weight")))


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def with_suffix(rows: DataFrame, suffixes: DataFrame) -> DataFrame:
    """``rows`` with their suffix's statistics, less ``own_n`` labels of which ``own_bad`` are bad if they have these."""
    own_n, own_bad = (F.col(c) if c in rows.columns else F.lit(0) for c in ("own_n", "own_bad"))
    n, bad = F.coalesce("suffix_n", F.lit(0)) - own_n, F.coalesce("suffix_bad", F.lit(0)) - own_bad
    return rows.join(broadcast_if_small(suffixes), "suffix", "left").select(
        *rows.columns, F.log1p(n).alias("suffix_log_count"), ((bad + 0.5) / (n + 1)).alias("suffix_bad_rate"))


def train(labelled: DataFrame, max_train: int = MAX_TRAIN, trees: int = 20, depth: int = 4,
          seed: int = 11) -> tuple[GBTClassificationModel | None, DataFrame]:
    """Trees from a bounded sample of ``(url, label)`` (none if all have one label), and ``(suffix, suffix_n, suffix_bad)`` of all of it."""
    host, path = host_and_path(F.col("url"))
    suffixes = cut_lineage(labelled.groupBy(suffix_of(host).alias("suffix")).agg(
        F.count("label").alias("suffix_n"), F.coalesce(F.sum("label"), F.lit(0)).alias("suffix_bad")), "url_suffixes")
    sample = cut_lineage(bounded_sample(labelled.select("url", "label"), max_train).dropDuplicates(["url"]), "labelled_urls")
    own = labelled.join(broadcast_if_small(sample.select("url")), "url").groupBy("url").agg(
        F.count("label").alias("own_n"), F.coalesce(F.sum("label"), F.lit(0)).alias("own_bad"))
    sample = sample.join(own, "url")
    sample = cut_lineage(lexical(sample.select("url", "label", "weight", "own_n", "own_bad", host.alias("host"), path.alias("path"))), "url_sample")
    if sample.select("label").distinct().count() < 2:
        return None, suffixes
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(with_suffix(sample, suffixes))
    rows = rows.select("features", F.col("label").cast("double").alias("label"), "weight").coalesce(8).persist()
    try:
        model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=seed, maxBins=32, weightCol="weight").fit(rows)
    finally:
        rows.unpersist()
    return model, suffixes


def judge_urls(pages: DataFrame, labelled: DataFrame | None = None, rules: Sequence[tuple[str, str]] = RULES,
               max_train: int = MAX_TRAIN, id_col: str = "page_id", url_col: str = "url", threshold: float = 0.5) -> DataFrame:
    """``(page_id, host, path, rule, verdict, bad_probability)`` per row of ``pages``."""
    urls = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    labelled = seed_labels(urls) if labelled is None else labelled.select("url", "label")
    model, suffixes = train(labelled, max_train)
    host, path = host_and_path(F.col("url"))
    rows = with_suffix(lexical(urls.select("page_id", "url", host.alias("host"), path.alias("path"))), suffixes)
    if model:
        rows = model.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows))
        bad = F.get(vector_to_array("probability"), F.lit(1))
    else:
        bad = F.lit(float(labelled.agg(F.max("label").alias("m")).first()["m"] or 0))   # the one label there is
    rule, said = rule_for(F.col("host"), F.col("path"), rules)
    return rows.select("page_id", "host", "path", rule.alias("rule"),
                       F.coalesce(said, F.when(bad >= threshold, "block").otherwise("allow")).alias("verdict"), bad.alias("bad_probability"))
