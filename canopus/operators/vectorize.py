"""Vectorisation: tag documents -> dictionary -> TF -> DF -> pruned TF -> TF-IDF.

Terms are counted where a document's tags are and written once, packed to a row of arrays per
document; nothing is shuffled by document and term. Stages are long-form DataFrames over it:
  doc_terms   (doc_id, term, tf INT)            per-document counts (A3 before encoding)
  term_counts (term, cf BIGINT)                 corpus counts (A1)
  dictionary  (term_id INT, term, cf BIGINT)    dense ids in binary term order (A2, P5)
  tf          (doc_id, term_id, tf INT)         encoded term frequencies (J1, A3)
  df          (term_id, df BIGINT)              document frequencies (A5)
  stats       (n_features, n_docs)              corpus counters (A6)
  pruned      (doc_id, term_id, tf, df)         min_df <= df <= threshold (A8, P6, J2)
  tfidf       (doc_id, term_id, weight DOUBLE)  weights (A9, P7) and optional norms (P10/P11)

Only scalars (corpus counters, one count per partition) reach the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canopus.config import VectorizeConfig
from canopus.operators.ngrams import GramFinder, TagRun, gram_finder, ngram_tokens, tag_runs
from canopus.operators.ranking import lookup_join, with_global_index
from canopus.session import cut_lineage, release, written_so_far


def doc_terms(tag_docs: DataFrame, cfg: VectorizeConfig = VectorizeConfig()) -> DataFrame:
    """``(doc_id, term, tf)``; documents with equal ids are pooled."""
    if cfg.max_ngram >= 2:
        tag_docs = cut_lineage(tag_docs.select("doc_id", "tags"), "tag_docs")   # parsed once for all passes
    # explode_outer + NOT NULL above the generator: no inferred size(tags) > 0 filter is
    # pushed below the parse (see sources.tags.parse_tag_lines)
    tokens = (tag_docs.select("doc_id", F.explode_outer("tags").alias("term")).where(F.col("term").isNotNull())
              .withColumn("tf", F.lit(1).cast("long")))
    if cfg.max_ngram >= 2:
        tokens = tokens.unionByName(ngram_tokens(tag_docs, cfg.max_ngram, cfg.min_support, cfg.min_llr))
    return tokens.groupBy("doc_id", "term").agg(F.sum("tf").cast("int").alias("tf"))


PACK_TAGS = 500_000   # tags counted at once by a task, whole documents


def _packed_rows(batch, row, terms):
    """A row for each document of ``batch`` with terms: in binary order, with their counts."""
    coded = terms.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    key, n = np.unique(row * len(order) + place[coded.indices.to_numpy()], return_counts=True)
    row, term = np.divmod(key, len(order))
    first = np.flatnonzero(np.diff(row, prepend=-1))
    ends = pa.array(np.append(first, len(row)).astype(np.int32))
    return pa.RecordBatch.from_arrays([
        batch.column("doc_id").take(pa.array(row[first])),
        pa.ListArray.from_arrays(ends, coded.dictionary.take(pa.array(order[term]))),
        pa.ListArray.from_arrays(ends, pa.array(n.astype(np.int32)))], names=["doc_id", "terms", "tfs"])


def _count_tags(batches):
    """The terms of each document in binary order, with their counts; none, no row."""
    for whole in batches:
        for batch in tag_runs(whole, PACK_TAGS):
            tags = batch.column("tags")
            terms, row = pc.list_flatten(tags), pc.list_parent_indices(tags).to_numpy()
            if terms.null_count:
                known = pc.is_valid(terms)
                terms, row = terms.filter(known), row[known.to_numpy(zero_copy_only=False)]
            if len(terms):
                yield _packed_rows(batch, row, terms)


def _count_grams(finder: GramFinder):
    """:func:`_count_tags` with the accepted n-grams beside the tags."""
    def run(batches):
        for whole in batches:
            for batch in tag_runs(whole, PACK_TAGS):
                tags = TagRun(batch)
                known = slice(None) if tags.missing is None else ~tags.missing
                rows, terms = [tags.row[known]], [tags.words.take(pa.array(tags.code[known]))]
                for row, place, strings in finder.find(tags):
                    rows.append(row)
                    terms.append(strings.take(pa.array(place)))
                row = np.concatenate(rows)
                if len(row):
                    yield _packed_rows(batch, row, pa.concat_arrays(terms))
    return run


def term_packs(tag_docs: DataFrame, finder: GramFinder | None = None) -> DataFrame:
    """``(doc_id, terms, tfs)``, a written row for each document with terms, and the accepted n-grams if
    there is a ``finder`` of them. Documents with equal ids are pooled; only these are shuffled."""
    schema = f"doc_id {tag_docs.schema['doc_id'].dataType.simpleString()}, terms array<string>, tfs array<int>"
    packs = cut_lineage(tag_docs.select("doc_id", "tags").mapInArrow(_count_tags if finder is None else _count_grams(finder), schema), "term_packs")
    again = cut_lineage(packs.groupBy("doc_id").agg(F.count("*").alias("n")).where(F.col("n") > 1).select(F.col("doc_id").alias("again")), "repeated_ids")
    if again.isEmpty():
        return packs
    same = F.col("doc_id").eqNullSafe(F.col("again"))
    pooled = packed_terms(packs.join(again, same, "left_semi")).groupBy("doc_id", "term").agg(F.sum("tf").cast("int").alias("tf"))
    own = F.array_sort(F.collect_list(F.struct("term", "tf")))
    pooled = pooled.groupBy("doc_id").agg(own.alias("_t")).select("doc_id", F.col("_t.term").alias("terms"), F.col("_t.tf").alias("tfs"))
    return cut_lineage(packs.join(again, same, "left_anti").unionByName(pooled), "term_packs")


def packed_terms(packs: DataFrame) -> DataFrame:
    """``(doc_id, term, tf)`` of :func:`term_packs`."""
    return packs.select("doc_id", "tfs", F.posexplode("terms").alias("_pos", "term")).select("doc_id", "term", F.col("tfs")[F.col("_pos")].alias("tf"))


def _count_packs(batches):
    for whole in batches:
        for batch in tag_runs(whole, PACK_TAGS, "terms"):
            coded = batch.column("terms").flatten().dictionary_encode()
            n, at = len(coded.dictionary), coded.indices.to_numpy()
            cf = np.bincount(at, weights=batch.column("tfs").flatten().to_numpy(), minlength=n)
            yield pa.RecordBatch.from_arrays([coded.dictionary, pa.array(cf.astype(np.int64)), pa.array(np.bincount(at, minlength=n).astype(np.int64))], names=["term", "cf", "df"])


def pack_counts(packs: DataFrame) -> DataFrame:
    """``(term, cf, df)`` of :func:`term_packs`, added up by batch before the shuffle."""
    parts = packs.select("terms", "tfs").mapInArrow(_count_packs, "term string, cf long, df long")
    return parts.groupBy("term").agg(F.sum("cf").alias("cf"), F.sum("df").alias("df"))


def term_counts(dt: DataFrame) -> DataFrame:
    return dt.groupBy("term").agg(F.sum("tf").cast("long").alias("cf"))


def build_dictionary(counts: DataFrame, min_support: int) -> tuple[DataFrame, int]:
    """Terms with ``cf >= min_support``, ids 0..V-1 in binary term order; other columns stay."""
    kept = counts.where(F.col("cf") >= min_support)
    ranked, size = with_global_index(kept, ["term"], "term_id")
    return ranked.select(F.col("term_id").cast("int"), *counts.columns), size


def term_frequency(dt: DataFrame, dictionary: DataFrame) -> DataFrame:
    return lookup_join(dt, dictionary.select("term", "term_id", "cf"), ["term"], F.col("cf")).select("doc_id", "term_id", "tf")


def document_frequency(tf: DataFrame) -> DataFrame:
    """One row per (doc, term) in ``tf``, so a plain count is the DF."""
    return tf.groupBy("term_id").agg(F.count("*").alias("df"))


def corpus_stats(tf: DataFrame) -> DataFrame:
    """1 row: distinct terms and documents present in the TF vectors."""
    # two counts of their own: two DISTINCTs in one aggregate would copy every row
    counts = (tf.select("term_id").distinct().count(), tf.select("doc_id").distinct().count())
    return tf.sparkSession.createDataFrame([counts], "n_features long, n_docs long")


def df_sigma(df: DataFrame) -> DataFrame:
    """1 row: standard deviation of DF about mean 0, ``sqrt(sum(df^2)/(V-1))``."""
    return df.agg(F.count("*").alias("n_terms"),
                  F.sqrt(F.try_divide(F.sum(F.col("df").cast("double") * F.col("df")),
                                      F.count("*") - 1)).alias("sigma_std"))


def max_df_percent_value(n_docs: int, max_df_percent: int, max_df_sigma: float | None,
                         std: float | None) -> int:
    if max_df_sigma is not None and max_df_sigma >= 0.0:
        return int(100.0 * max_df_sigma * std / n_docs)  # truncation toward zero
    return int(max_df_percent)


def max_df_threshold(n_docs: int, max_df: int) -> int:
    """``(long)(N * (maxDF / 100.0f))`` evaluated in float32, truncated."""
    return int(np.float32(n_docs) * (np.float32(max_df) / np.float32(100.0)))


def max_df_threshold_col(n_docs: Column, max_df: Column) -> Column:
    """Column form of :func:`max_df_threshold` (Spark's float/float is double, so the
    quotient is cast back to float before the float multiplication)."""
    q = (max_df.cast("float") / F.lit(100.0).cast("float")).cast("float")
    return (n_docs.cast("float") * q).cast("long")


def prune_by_df(tf: DataFrame, df: DataFrame, min_df: int, threshold: int) -> DataFrame:
    keep = df.where((F.col("df") >= min_df) & (F.col("df") <= threshold))
    return lookup_join(tf, keep, ["term_id"], F.col("df")).select("doc_id", "term_id", "tf", "df")


def weight_col(tf: Column, df: Column, n_docs: int, min_df: int, scheme: str) -> Column:
    if scheme == "classic":
        return F.sqrt(tf.cast("double")) * (F.lit(1.0) + F.log(
            F.lit(float(n_docs)) / (F.greatest(df, F.lit(min_df)).cast("double") + 1.0)))
    if scheme == "smooth":
        return tf.cast("double") * F.log((F.lit(float(n_docs)) + 1.0) / (df.cast("double") + 1.0))
    raise ValueError(f"unknown weighting scheme {scheme!r}")


def tfidf(pruned: DataFrame, n_docs: int, cfg: VectorizeConfig = VectorizeConfig()) -> DataFrame:
    out = pruned
    if cfg.second_df_filter:
        out = out.where(F.lit(100.0) * F.col("df") / F.lit(float(n_docs)) <= F.lit(float(cfg.max_df_percent)))
    out = out.select("doc_id", "term_id",
                     weight_col(F.col("tf"), F.col("df"), n_docs, cfg.min_df, cfg.scheme).alias("weight"))
    if cfg.norm is not None:
        out = normalize(out, cfg.norm, cfg.log_normalize)
    return out


def normalize(vecs: DataFrame, p: float | str, log: bool = False) -> DataFrame:
    """Per-document L_p normalisation of ``(doc_id, term_id, weight)``.

    p = 0 divides by the number of non-zeros, "INF" by the largest magnitude, otherwise
    by ``(sum |w|^p)^(1/p)``. With ``log`` the value is ``ln(1+w) / (ln p * ||w||_p)``,
    which needs 1 < p < inf. Documents with a zero norm are left unchanged.
    """
    doc = Window.partitionBy("doc_id")
    w = F.col("weight")
    if isinstance(p, str):
        if p.upper() != "INF":
            raise ValueError(f"norm must be a number >= 0 or 'INF', got {p!r}")
        if log:
            raise ValueError("log normalisation needs 1 < p < inf")
        norm = F.max(F.abs(w)).over(doc)
    else:
        p = float(p)
        if p < 0:
            raise ValueError("norm must be >= 0")
        if log and not (1.0 < p < math.inf):
            raise ValueError("log normalisation needs 1 < p < inf")
        if p == 0.0:
            norm = F.sum(F.when(w != 0, 1.0).otherwise(0.0)).over(doc)
        elif p == 1.0:
            norm = F.sum(F.abs(w)).over(doc)
        elif p == 2.0:
            norm = F.sqrt(F.sum(w * w).over(doc))
        else:
            norm = F.pow(F.sum(F.pow(F.abs(w), F.lit(p))).over(doc), F.lit(1.0 / p))
    if log:
        value = F.log1p(w) / (F.lit(math.log(p)) * norm)
    else:
        value = w / norm
    return vecs.select("doc_id", "term_id", F.when(norm == 0, w).otherwise(value).alias("weight"))


@dataclass
class Stages:
    """Every intermediate table of one vectorisation run plus its scalars."""
    tag_docs: DataFrame
    doc_terms: DataFrame
    term_counts: DataFrame
    dictionary: DataFrame
    tf: DataFrame
    df: DataFrame
    pruned: DataFrame
    tfidf: DataFrame
    n_docs: int
    n_features: int
    max_df: int
    threshold: int
    sigma_std: float | None


def vectorize(tag_docs: DataFrame, cfg: VectorizeConfig = VectorizeConfig()) -> Stages:
    """Run A1..A9. The packed terms, their counts and TF with each term's DF are written once and
    read back by the stages that use them; pruning and weighting stay lazy filters over TF."""
    spark, finder, first = tag_docs.sparkSession, None, written_so_far(tag_docs.sparkSession)
    if cfg.max_ngram >= 2:
        written = cut_lineage(tag_docs.select("doc_id", "tags"), "tag_docs")   # parsed once for all passes
        finder = gram_finder(written, cfg.max_ngram, cfg.min_support, cfg.min_llr)
    by_rows = cfg.max_ngram >= 2 and finder is None
    if by_rows:
        dt = cut_lineage(doc_terms(tag_docs, cfg), "doc_terms")
        counts = term_counts(dt)
        dictionary, _ = build_dictionary(counts, cfg.min_support)
        tf = cut_lineage(term_frequency(dt, dictionary), "tf")
        df = cut_lineage(document_frequency(tf), "df")
        n_features = df.count()
    else:
        last = written_so_far(spark)
        packs = term_packs(tag_docs if finder is None else written, finder)
        release(spark, first, last=last)   # what only the n-grams' choice read
        dt = packed_terms(packs)
        counts = cut_lineage(pack_counts(packs), "term_counts")
        known, n_features = build_dictionary(counts, cfg.min_support)
        with_df = cut_lineage(lookup_join(dt, known.select("term", "term_id", "df"), ["term"], F.col("df")).select("doc_id", "term_id", "tf", "df"), "tf")
        counts, dictionary, df, tf = counts.select("term", "cf"), known.select("term_id", "term", "cf"), known.select("term_id", "df"), with_df.drop("df")
    n_docs = tf.select("doc_id").distinct().count()
    std = None
    if cfg.max_df_sigma is not None and cfg.max_df_sigma >= 0:
        std = df_sigma(df).first()["sigma_std"] or 0.0
    max_df = max_df_percent_value(n_docs, cfg.max_df_percent, cfg.max_df_sigma, std) if n_docs else 0
    threshold = max_df_threshold(n_docs, max_df)
    pruned = prune_by_df(tf, df, cfg.min_df, threshold) if by_rows else with_df.where((F.col("df") >= cfg.min_df) & (F.col("df") <= threshold))
    weighted = tfidf(pruned, n_docs, cfg)
    return Stages(tag_docs, dt, counts, dictionary, tf, df, pruned, weighted,
                  n_docs, n_features, max_df, threshold, std)
