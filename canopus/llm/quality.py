"""Quality rules with cross-document line frequency.

Base rules look at one document: its words, symbols, repeated lines and words in repeated
3-word windows. The cross-document rule hashes each normalised line (lower case, white
space as one space) and counts, per host (``source``), the distinct documents that hold
it. A line is *common* if more than ``min_docs`` of them hold it, whatever the host's size.
Common lines are removed; a document of which less than ``min_left`` of its words remain is
depleted and rejected.

Copies of a document count once, else every line of an often copied clean text would be
common. The rule that tells documents apart is exact (``oracle.QUALITY_SQL`` has it too):

* a line in more than ``min_docs`` different texts of the host is *frequent*; texts are
  different if their sets of lines are. Documents without one have no common line;
* an other line of a document with frequent lines is a changed copy if a quarter of its
  sketch (the 8 least of its 3-word windows) is in the sketches of the host's frequent lines;
* the remaining lines are the document's own. Documents are the same if their own lines are,
  however many frequent lines stand beside them; those without own lines are copies and the
  same if their least frequent line is (least as a string).

DataFrame operations only. A line of a third of all documents is counted by partial
aggregation; frequent and common lines are broadcast only if they are few (measured), else
joined. Sketches are made of documents with frequent lines alone.

Defined results: null text has no words and fails the base rules; null ``source`` is the
host ""; repeated rows are judged each (and count once); a very long text or line is judged
whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopus.session import cut_lineage

from .common import ASCII_SPACE, broadcast_if_small, by_key, words

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Windows kept of a line, and the share of them in frequent lines that makes it a changed copy.
SKETCH, ALIKE = 8, 0.25


@dataclass(frozen=True)
class QualityRules:
    min_words: int = 50
    max_repeat_percent: int = 50
    min_docs: int = 10
    min_left: float = 0.3


def normal(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, ASCII_SPACE, " ")))


def line_key(normalised: Column) -> Column:
    return F.xxhash64(normalised)


def normal_lines(text: Column) -> Column:
    """The normalised lines that have a word."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), normal), lambda x: x != "")


def sketch(line: Column) -> Column:
    """Hashes of the least 3-word windows of a normalised line; of the line if it has fewer words."""
    def of(w: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - 2, F.lit(1))), lambda i: F.array_join(F.slice(w, i, 3), " "))
        return F.transform(F.slice(F.sort_array(F.array_distinct(windows)), 1, SKETCH), lambda x: F.xxhash64(x))

    return F.get(F.transform(F.array(F.split(line, " ")), of), F.lit(0))   # bound to a variable, the words are split once


def base_columns(docs: DataFrame) -> DataFrame:
    """``docs`` with the base rules' figures and its lines' hashes and words. Equal 3-word
    windows are neighbours once (hash, place) pairs are sorted; a place covers the words up
    to the next one, three at most."""
    text = F.col("text")
    step = (docs.withColumn("words", words(text))
            .withColumn("n_words", F.size("words").cast("long"))
            .withColumn("word_hashes", F.transform("words", lambda w: F.xxhash64(w)))
            .withColumn("lines", F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
            .withColumn("normal_lines", F.transform("lines", normal)))
    windows = F.when(F.col("n_words") >= 3, F.transform(
        F.slice("word_hashes", F.lit(1), F.greatest(F.size("word_hashes") - 2, F.lit(0))),
        lambda h, i: F.struct(F.xxhash64(h, F.get("word_hashes", i + 1), F.get("word_hashes", i + 2)).alias("h"), i.alias("p"))))
    step = step.withColumn("windows", F.sort_array(windows))
    found = F.filter("windows", lambda x, i: (x["h"] == F.get("windows", i - 1)["h"]) | (x["h"] == F.get("windows", i + 1)["h"]))
    step = step.withColumn("places", F.sort_array(F.transform(found, lambda x: x["p"])))
    covered = F.transform("places", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("places", i + 1) - p, F.lit(3))))
    n_chars = F.coalesce(F.length(text), F.lit(0))

    def without(chars: str) -> Column:
        return F.coalesce(F.length(F.translate(text, chars, "")), F.lit(0))

    return step.select(
        *docs.columns, "n_words", without(SPACES).cast("long").alias("word_chars"),
        (n_chars - without(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.aggregate(covered, F.lit(0), lambda a, b: a + b), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.transform("normal_lines", lambda x: F.struct(
            line_key(x).alias("key"),
            (F.length(x) - F.length(F.translate(x, " ", "")) + 1).alias("n"))).alias("lines"))


def frequent_lines(base: DataFrame, rules: QualityRules) -> DataFrame:
    """``(host, key)`` of lines in more than ``min_docs`` different texts of the host."""
    keys = F.sort_array(F.array_distinct(F.transform("lines", lambda x: x["key"])))
    texts = base.where(F.size("lines") > 0).select("host", keys.alias("keys"))
    lines = texts.select("host", F.xxhash64("keys").alias("same"), F.explode("keys").alias("key"))
    often = lines.groupBy("host", "key").agg(F.count_distinct("same").alias("n")).where(F.col("n") > rules.min_docs)
    return broadcast_if_small(cut_lineage(often.select("host", "key"), "frequent_lines"))


def common_lines(rows: DataFrame, base: DataFrame, frequent: DataFrame, rules: QualityRules) -> DataFrame:
    """``(host, key)`` of lines in more than ``min_docs`` distinct documents of the host.
    ``rows`` has the texts again, by ``doc``, of which those with frequent lines are read."""
    each = base.select("doc", "host", F.explode("lines.key").alias("key"))
    touched = broadcast_if_small(cut_lineage(each.join(frequent, ["host", "key"]).select("doc").distinct(), "touched"))
    lines = rows.join(touched, "doc", "left_semi").select("doc", "host", F.array_distinct(normal_lines(F.col("text"))).alias("lines")).dropDuplicates(["doc"])
    lines = lines.select("doc", "host", F.explode("lines").alias("line")).withColumn("key", line_key(F.col("line")))
    often = frequent.withColumn("often", F.lit(True))
    lines = (lines.join(often, ["host", "key"], "left").withColumn("often", F.coalesce("often", F.lit(False)))
             .select("doc", "host", "key", "often", sketch(F.col("line")).alias("sketch"), F.when(F.col("often"), F.col("line")).alias("line")))
    lines = cut_lineage(lines, "touched_lines")
    windows = lines.where("often").select("host", F.explode("sketch").alias("window")).distinct()
    windows = broadcast_if_small(cut_lineage(windows, "frequent_windows"))
    rest = lines.where(~F.col("often"))
    changed = (rest.select("doc", "host", "key", F.size("sketch").alias("size"), F.explode("sketch").alias("window"))
               .join(windows, ["host", "window"]).groupBy("doc", "key").agg(F.count("*").alias("found"), F.first("size").alias("size"))
               .where(F.col("found") >= ALIKE * F.col("size")).select("doc", "key"))
    own = (rest.select("doc", "key").join(cut_lineage(changed, "changed_lines"), ["doc", "key"], "left_anti")
           .groupBy("doc").agg(F.xxhash64(F.sort_array(F.collect_list("key"))).alias("own")))   # a document's lines
    least = lines.where("often").groupBy("doc").agg(F.xxhash64(F.min("line")).alias("least"))
    told = cut_lineage(least.join(own, "doc", "left").select(
        "doc", F.struct(F.col("own").isNull().alias("copy"), F.coalesce("own", "least").alias("of")).alias("told")), "told_apart")
    found = lines.where("often").select("doc", "host", "key").join(told, "doc").groupBy("host", "key").agg(F.count_distinct("told").alias("n"))
    return broadcast_if_small(cut_lineage(found.where(F.col("n") > rules.min_docs).select("host", "key"), "common_lines"))


def _analyse(docs: DataFrame, rules: QualityRules, id_col: str, text_col: str, host_col: str) -> tuple[DataFrame, DataFrame]:
    """The rows' figures, and their common lines ``(row, doc_id, text_key, key, n)``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"), text_and_host_key(text_col, host_col).alias("text_key"))
    rows = rows.withColumn("doc", F.xxhash64("doc_id", "text_key"))   # equal for repeated rows
    base = cut_lineage(base_columns(rows.withColumn("row", F.monotonically_increasing_id())).drop("text"), "quality_base")
    common = common_lines(rows, base, frequent_lines(base, rules), rules)
    lines = (base.select("row", "doc_id", "text_key", "host", F.explode("lines").alias("line"))
             .select("row", "doc_id", "text_key", "host", F.col("line.key").alias("key"), F.col("line.n").alias("n")))
    return base.drop("lines", "host", "doc"), lines.join(common, ["host", "key"])


def judge(docs: DataFrame, rules: QualityRules = QualityRules(), id_col: str = "doc_id", text_col: str = "text",
          host_col: str = "source") -> DataFrame:
    """Per row ``doc_id``, the base figures, ``base_failed``, ``kept`` and, after them,
    ``left_words`` (outside common lines) and ``text_key`` (tells rows of an id apart)."""
    base, found = _analyse(docs, rules, id_col, text_col, host_col)
    removed = found.groupBy("row").agg(F.sum("n").alias("removed"))
    failed = ((F.col("n_words") < rules.min_words)
              | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")))
    left = F.col("n_words") - F.coalesce("removed", F.lit(0))
    return (base.join(removed, "row", "left")
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    failed.alias("base_failed"), (~failed & (left >= rules.min_left * F.col("n_words"))).alias("kept"),
                    left.alias("left_words"), "text_key"))


def without_common_lines(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """``docs`` with the common lines taken out of ``text``; all else as it is."""
    _, found = _analyse(docs, rules, "doc_id", "text", "source")
    keys = cut_lineage(found.groupBy("doc_id", "text_key").agg(F.collect_set("key").alias("keys")), "common_of_documents")   # a document's lines
    keys = broadcast_if_small(keys)
    same = docs["doc_id"].eqNullSafe(keys["doc_id"]) & (text_and_host_key() == keys["text_key"])
    kept = F.array_join(F.filter(F.split(docs["text"], "\n"), lambda x: ~F.array_contains(keys["keys"], line_key(normal(x)))), "\n")
    text = F.when(keys["keys"].isNull(), docs["text"]).otherwise(kept)
    return docs.join(keys, same, "left").select(*(text.alias("text") if c == "text" else docs[c] for c in docs.columns))


def text_and_host_key(text_col: str = "text", host_col: str = "source") -> Column:
    """With the id, tells rows apart whose verdicts may differ."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")), F.coalesce(F.col(host_col).cast("string"), F.lit("")))


def keep_good(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """``docs`` without the rows that :func:`judge` rejects, all columns as they are."""
    bad = judge(docs, rules).where(~F.col("kept")).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    return by_key(docs, cut_lineage(bad, "quality_rejected"), text_and_host_key(), "left_anti")
