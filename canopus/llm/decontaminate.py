"""Benchmark decontamination by a distributed positional inverted index.

The index holds postings ``(row, term, pos)`` of the training documents for every term of
the test windows, and one entry per document with its id and number of words; it is
written in one pass over the texts. A window is looked up from its rarest terms: the
postings of the rarest give candidate starts (position less the term's offset), which are
intersected with the offset-adjusted postings of the next rarest; what is left is checked
against the postings of all its terms, in the documents concerned. Phrase matches have the
terms at consecutive positions; proximity matches have them all, in any order, at most
``slop`` positions from an occurrence of the rarest (the first in the window of the rarest
alike). Postings meet by blocks of ``slop`` positions, so a term that fills a very long text
costs in proportion to its postings.

DataFrame operations only. Test-side tables (terms, windows) are broadcast if measured to
be small, else joined by shuffle; postings of a hot term are never gathered in one group.

Defined results: null text or no word gives no windows and no hits; repeated documents are
matched each; repeated items are items each, equal item ids are one item; very long texts
are indexed whole, a posting a row; an empty table on either side gives no hits; other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canopus.session import cut_lineage

from .common import ascii_lower, broadcast_if_small, by_key, text_key

WINDOW = 10
#: Positions around the rarest term of a window in a proximity match.
SLOP = 20
#: Between words: ASCII other than digits and lower-case letters (of lower-cased text).
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_DOCUMENT = -1   # the term id of a document's own entry


def phrase_words(col: Column) -> Column:
    return F.filter(F.split(ascii_lower(F.coalesce(col, F.lit(""))), BETWEEN), lambda w: w != "")


@dataclass
class Queries:
    """``windows``: (win, n, items); ``terms``: (win, offset, term_id); ``vocabulary``: (term, term_id)."""

    windows: DataFrame
    terms: DataFrame
    vocabulary: DataFrame


def test_windows(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> Queries:
    """Distinct windows of the items: ``window`` consecutive words; the whole of a shorter item."""
    w = F.col("words")
    spans = F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - window + 1, F.lit(1))), lambda i: F.slice(w, i, window))
    items = (benchmark.select(F.col(id_col).cast("string").alias("item"), phrase_words(F.col(text_col)).alias("words"))
             .where(F.size("words") > 0).select("item", F.explode(spans).alias("span")).distinct())
    windows = cut_lineage(items.groupBy("span").agg(F.collect_set("item").alias("items"))
                          .select(F.monotonically_increasing_id().alias("win"), "span", F.size("span").alias("n"), "items"), "windows")
    terms = windows.select("win", F.posexplode("span").alias("offset", "term"))
    vocabulary = cut_lineage(terms.select("term").distinct().select("term", F.monotonically_increasing_id().alias("term_id")), "terms")
    return Queries(windows.select("win", "n", "items"),
                   cut_lineage(terms.join(vocabulary, "term").select("win", "offset", "term_id"), "window_terms"), vocabulary)


def build_index(docs: DataFrame, vocabulary: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings ``(row, term_id, pos)`` of the vocabulary's terms, positions from 1, and per
    document an entry with term id -1, ``doc_id``, ``n_words`` and ``text_key``."""
    spark = docs.sparkSession
    known = broadcast_if_small(vocabulary.unionByName(spark.sql(f"SELECT '' AS term, {_DOCUMENT}L AS term_id")))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       text_key(text_col).alias("text_key"),
                       phrase_words(F.col(text_col)).alias("words"))
    rows = rows.withColumn("n_words", F.size("words"))
    # the empty string, which is no word, stands for the document itself
    postings = rows.select("row", "doc_id", "text_key", "n_words", F.posexplode(F.concat(F.array(F.lit("")), "words")).alias("pos", "term"))
    own = F.col("pos") == 0
    return cut_lineage(postings.join(known, "term").select(
        "row", "term_id", "pos", *(F.when(own, F.col(c)).alias(c) for c in ("doc_id", "text_key", "n_words"))),
        "postings")


def _rare_terms(index: DataFrame, q: Queries) -> DataFrame:
    """Per window whose terms all occur: its rarest and second rarest term with offsets."""
    found = index.where(F.col("term_id") >= 0).groupBy("term_id").agg(F.count("*").alias("postings"))
    ranked = q.terms.join(found, "term_id").withColumn(
        "rank", F.row_number().over(Window.partitionBy("win").orderBy("postings", "offset")))
    least = F.sort_array(F.collect_list(F.struct("rank", "term_id", "offset")))   # a window's terms
    rare = ranked.groupBy("win").agg(least.alias("t")).join(q.windows.select("win", "n"), "win").where(F.size("t") == F.col("n"))
    first, second = F.get("t", F.lit(0)), F.coalesce(F.get("t", F.lit(1)), F.get("t", F.lit(0)))   # one word: itself
    return cut_lineage(rare.select("win", "n", first["term_id"].alias("term_id"), first["offset"].alias("offset"),
                                   second["term_id"].alias("next_id"), (second["offset"] - first["offset"]).alias("ahead")), "rare_terms")


def _of_terms(index: DataFrame, terms: DataFrame) -> DataFrame:
    return index.join(broadcast_if_small(terms.distinct()), "term_id", "left_semi").select("row", "term_id", "pos")


def _of_rows(index: DataFrame, rows: DataFrame) -> DataFrame:
    """Postings of the documents ``rows`` has."""
    rows = broadcast_if_small(cut_lineage(rows.select("row").distinct(), "candidate_rows"))
    return index.where(F.col("term_id") >= 0).join(rows, "row", "left_semi").select("row", "term_id", "pos")


def phrase_matches(index: DataFrame, q: Queries) -> DataFrame:
    """``(row, win, start, n)``: window ``win`` occurs at word ``start`` (from 1), ``n`` words long."""
    rare = _rare_terms(index, q)
    starts = (_of_terms(index, rare.select("term_id")).join(broadcast_if_small(rare), "term_id")
              .select("row", "win", "n", (F.col("pos") - F.col("offset")).alias("start"), F.col("next_id").alias("term_id"),
                      (F.col("pos") + F.col("ahead")).alias("pos")))
    second = _of_terms(index, rare.select(F.col("next_id").alias("term_id")))
    likely = cut_lineage(starts.join(second, ["row", "term_id", "pos"]).select("row", "win", "n", "start"), "likely_phrases")
    wanted = likely.join(broadcast_if_small(q.terms), "win").withColumn("pos", F.col("start") + F.col("offset"))
    return (wanted.join(_of_rows(index, likely), ["row", "term_id", "pos"])
            .groupBy("row", "win", "start", "n").agg(F.count("*").alias("found")).where(F.col("found") == F.col("n"))
            .select("row", "win", "start", "n"))


def _near(wanted: DataFrame, postings: DataFrame, slop: int) -> DataFrame:
    """``wanted`` (with ``row``, ``term_id``, ``at``) by ``postings`` of that term at most ``slop`` positions from ``at``."""
    block = F.floor(F.col("at") / slop)
    return (wanted.withColumn("block", F.explode(F.array(block - 1, block, block + 1)))
            .join(postings.withColumn("block", F.floor(F.col("pos") / slop)), ["row", "term_id", "block"])
            .where(F.abs(F.col("pos") - F.col("at")) <= slop).drop("block", "pos"))


def proximity_matches(index: DataFrame, q: Queries, slop: int = SLOP) -> DataFrame:
    """``(row, win, pos)``: all of the window's different terms are at most ``slop`` words
    from its rarest, which is at ``pos``."""
    rare = _rare_terms(index, q)
    around = (_of_terms(index, rare.select("term_id")).join(broadcast_if_small(rare), "term_id")
              .select("row", "win", F.col("pos").alias("at"), F.col("next_id").alias("term_id")))
    second = _of_terms(index, rare.select(F.col("next_id").alias("term_id")))
    likely = cut_lineage(_near(around, second, slop).select("row", "win", "at").distinct(), "likely_near")
    terms = cut_lineage(q.terms.select("win", "term_id").distinct(), "window_sets")
    n = cut_lineage(terms.groupBy("win").agg(F.count("*").alias("n")), "window_set_sizes")
    return (_near(likely.join(broadcast_if_small(terms), "win"), _of_rows(index, likely), slop)
            .groupBy("row", "win", "at").agg(F.count_distinct("term_id").alias("found")).join(broadcast_if_small(n), "win")
            .where(F.col("found") == F.col("n")).select("row", "win", F.col("at").alias("pos")))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int | None = None) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, ``n_hit`` (words inside an occurring
    window), ``n_items``, ``items_sha256``, ``contaminated`` and ``text_key``; with ``slop`` also
    ``n_near``, the items with a proximity match of a window."""
    q = test_windows(benchmark, window)
    index = build_index(docs, q.vocabulary)
    found = cut_lineage(phrase_matches(index, q), "phrase_matches")
    hit = (found.select("row", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("pos")).distinct()
           .groupBy("row").agg(F.count("*").alias("n_hit")))
    of_windows = broadcast_if_small(q.windows.select("win", "items"))
    items = (found.select("row", "win").distinct().join(of_windows, "win")
             .groupBy("row").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")))   # at most all items
    own = index.where(F.col("term_id") == _DOCUMENT).select("row", "doc_id", "text_key", "n_words")
    own = own.join(hit.join(items, "row"), "row", "left")
    more = []
    if slop is not None:
        near = proximity_matches(index, q, slop).select("row", "win").distinct().join(of_windows, "win")
        near = near.select("row", F.explode("items").alias("item")).distinct().groupBy("row").agg(F.count("*").alias("near"))
        own = own.join(near, "row", "left")
        more = [F.coalesce("near", F.lit(0)).cast("long").alias("n_near")]
    return own.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.array_size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.concat_ws(",", "items"), F.lit("")), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"), *more, "text_key")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without contaminated rows, all columns as they are."""
    bad = contamination(docs, benchmark, window).where("contaminated").select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    return by_key(docs, cut_lineage(bad, "contaminated"), text_key(), "left_anti")
