"""Licence scan: a trained paragraph classifier with template comparison.

A paragraph is a run of lines that hold a letter or digit. It is judged in pieces: the
``PIECE_WORDS`` words from each of its lines on (lines that are longer also from every
``PIECE_STEP``-th word on), and each line by itself; so wrapped notices, notices inside long
lines and notices between other lines all have a piece that is little else. Candidates are
the pieces with a stem of licence vocabulary; any other is unknown. Word unigrams and
bigrams, hashed to a sparse vector, go to a multinomial logistic regression over the licence
families and *unknown*, trained from the families' templates in many variants (words left
out, other words around), the texts that follow them, sentences that use the same words
otherwise, and a bounded sample (``background`` documents) of the corpus's own lines. A
second, one-dimensional regression on held-out variants turns the best family's odds into a
calibrated probability of being right; below one half the piece is unknown. A prediction
stands only if ``min_overlap`` of the word bigrams of one of the family's templates are in
the piece. Of a paragraph's pieces of one family the one that holds most of a template
counts, the last of them if they are alike: it starts on the notice's first line.

Defined results: null or blank text has no paragraphs and no licence; very long texts are cut
into pieces like any other, and each worker holds one Arrow batch of candidate texts of a
few rows; repeated rows are scanned each; ties between families go to the alphabet's first;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canopus.session import cut_lineage

from .common import chunks
from .license_templates import BODIES, OTHERS, STEMS, TEMPLATES
from .url_filter import bounded_sample

UNKNOWN = "unknown"
FEATURES = 1 << 12
BACKGROUND = 400
MIN_OVERLAP = 0.6
#: Words of a piece and, in longer lines, between the starts of pieces: notices of up to
#: PIECE_WORDS - PIECE_STEP words are whole in one of them.
PIECE_WORDS, PIECE_STEP = 56, 16
_STEM = re.compile("|".join(r"[\W_]+".join(stem.split(" ")) for stem in STEMS), re.IGNORECASE)
_HAS_WORD = re.compile(r"[^\W_]")
_WORD = r"[a-z0-9]+(?:[.+-][a-z0-9]+)*"


def tokens(text: Column) -> Column:
    """Lower-case words; ``\\d+`` at the end of a version stays part of it."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({_WORD})"), 1)


def bigrams(w: Column) -> Column:
    """Neighbouring words; the word itself if it is the only one."""
    pairs = F.transform(F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))), lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1)))
    return F.array_distinct(F.when(F.size(w) > 1, pairs).otherwise(w))


def variants(text: str, n: int, rng: random.Random) -> list[str]:
    """The notice as it is and with words before, after (up to a whole piece), left out or in capitals."""
    extra = "the a project code file see details for team company 2019 2021 inc gmbh and contributors website here version notice".split()
    out = [text, text.upper(), text.rstrip(".")]
    while len(out) < n:
        w = text.replace("{}", rng.choice(("2020", "Example Ltd", "the authors"))).split()
        if len(w) > 6 and rng.random() < 0.5:
            del w[rng.randrange(len(w))]
        head = rng.choices(extra, k=rng.randrange(4)) if rng.random() < 0.5 else []
        room = max(6, PIECE_WORDS - len(w) - len(head)) if rng.random() < 0.3 else 6
        tail = rng.choices(extra, k=rng.randrange(room)) if rng.random() < 0.5 else []
        out.append(" ".join(head + w + tail))
    return out


def training_rows(seed: int = 5, n: int = 24) -> list[tuple[str, str, bool]]:
    """``(text, family, held out)``."""
    rng, rows = random.Random(seed), []
    for family, notices in [*TEMPLATES.items(), *BODIES.items(), (UNKNOWN, OTHERS)]:
        for notice in notices:
            rows += [(v, family, i % 4 == 3) for i, v in enumerate(variants(notice, n, rng))]
    return rows


@dataclass
class LicenseModel:
    classes: list[str]
    regression: LogisticRegressionModel
    slope: float
    intercept: float


def _vectors(rows: DataFrame) -> DataFrame:
    """``rows`` with ``words``, ``grams`` and ``features`` of ``text``."""
    rows = rows.withColumn("words", tokens(F.col("text"))).withColumn("grams", bigrams(F.col("words")))
    rows = rows.withColumn("ngrams", F.concat("words", "grams"))
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="ngrams", outputCol="features").transform(rows)


def _best(scored: DataFrame, classes: list[str]) -> DataFrame:
    """Adds the likeliest family and the log odds of its probability."""
    p = F.transform(vector_to_array("probability"), lambda x, i: F.struct(x.alias("p"), (-i).alias("order")))
    ranked = F.sort_array(F.filter(p, lambda x: x["order"] != -classes.index(UNKNOWN)), asc=False)
    best = F.least(F.greatest(ranked[0]["p"], F.lit(1e-9)), F.lit(1 - 1e-9))
    return (scored.withColumn("family", F.element_at(F.array(*map(F.lit, classes)), 1 - ranked[0]["order"]))
            .withColumn("odds", F.log(best / (1 - best))))


def train(spark: SparkSession, docs: DataFrame, background: int = BACKGROUND, seed: int = 5) -> LicenseModel:
    """Trains on the templates and the lines of about ``background`` of ``docs`` (``doc_id``, ``text``)."""
    classes = sorted([*TEMPLATES, UNKNOWN])
    made = spark.createDataFrame(training_rows(seed), "text string, family string, held boolean")
    lines = (bounded_sample(docs.withColumn("label", F.lit(0)), background).select(F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("text"))
             .where(~has_stem(F.col("text")) & (F.trim("text") != ""))
             .select("text", F.lit(UNKNOWN).alias("family"), (F.pmod(F.xxhash64("text"), F.lit(4)) == 3).alias("held")))
    label = F.array_position(F.array(*map(F.lit, classes)), F.col("family")) - 1
    rows = cut_lineage(_vectors(made.unionByName(lines)).select("features", "family", "held", label.cast("double").alias("label")).coalesce(4), "license_training")
    regression = LogisticRegression(family="multinomial", regParam=1e-3, maxIter=50).fit(rows.where(~F.col("held")))
    held = _best(regression.transform(rows.where("held")).select("probability", F.col("family").alias("true")), classes)
    held = held.select((F.col("family") == F.col("true")).cast("double").alias("label"), "odds")
    held = VectorAssembler(inputCols=["odds"], outputCol="features").transform(held)
    calibration = LogisticRegression(regParam=1e-3, maxIter=50).fit(held)
    return LicenseModel(classes, regression, float(calibration.coefficients[0]), float(calibration.intercept))


def has_stem(text: Column) -> Column:
    return F.coalesce(text.rlike("(?i)" + _STEM.pattern), F.lit(False))


@dataclass
class Paragraph:
    """Words of a run of lines, the number of each line (from 1) and of its first word."""

    words: list[str]
    lines: list[tuple[int, int]]


def paragraphs(text: str) -> Iterator[Paragraph]:
    """Runs of lines that hold a letter or digit; words are what white space separates, without
    signs that stand alone (comment markers, list dots)."""
    held = Paragraph([], [])
    for number, line in enumerate(text.split("\n"), 1):
        own = [w for w in line.split() if _HAS_WORD.search(w)]
        if own:
            held.lines.append((number, len(held.words)))
            held.words += own
        elif held.lines:
            yield held
            held = Paragraph([], [])
    if held.lines:
        yield held


def pieces(p: Paragraph) -> Iterator[tuple[int, str]]:
    """``(first line, text)`` of the pieces of ``p`` that hold a stem."""
    ends = [start for _, start in p.lines[1:]] + [len(p.words)]
    for (number, start), end in zip(p.lines, ends, strict=True):
        whole = end - start <= PIECE_WORDS
        for at in range(start, start + 1 if whole else end, PIECE_STEP):
            text = " ".join(p.words[at:at + PIECE_WORDS])
            if _STEM.search(text):
                yield number, text
        if whole and (line := " ".join(p.words[start:end])) != " ".join(p.words[start:start + PIECE_WORDS]) and _STEM.search(line):
            yield number, line


#: What a worker gives: per document a row with its counts and no paragraph, per piece a row with no counts.
_FOUND = pa.schema([(name, pa.int64()) for name in ("row", "doc_id", "n_paragraphs", "n_candidates", "paragraph", "line")] + [("text", pa.string())])


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, ids = batch.column("row").to_pylist(), batch.column("doc_id").to_pylist()
        for first, texts in chunks(batch.column("text")):
            out = []
            for i, raw in enumerate(texts, first):
                text = raw.decode()
                some = _STEM.search(text) is not None
                n = candidates = 0
                for n, p in enumerate(paragraphs(text), 1):  # noqa: B007
                    own = list(pieces(p)) if some else []
                    candidates += bool(own)
                    out += [(rows[i], None, None, None, n, line, piece) for line, piece in own]
                out.append((rows[i], ids[i], n, candidates, None, None, None))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _FOUND, strict=True)], schema=_FOUND)


def template_table(spark: SparkSession) -> DataFrame:
    """``(family, templates)``: each notice's bigrams. A few dozen rows, whatever the corpus."""
    rows = [(f, re.sub(r"\{\}\s*", "", t)) for f, notices in TEMPLATES.items() for t in notices]
    table = spark.createDataFrame(rows, "family string, text string").withColumn("words", tokens(F.col("text")))
    return table.withColumn("grams", bigrams(F.col("words"))).groupBy("family").agg(F.collect_list("grams").alias("templates"))


def classify(paragraphs: DataFrame, model: LicenseModel, min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """``paragraphs`` (with ``text``) with ``family`` (``unknown`` if unsure or unlike its
    templates), ``confidence`` and ``overlap``."""
    keep = paragraphs.columns
    scored = _best(model.regression.transform(_vectors(paragraphs)), model.classes)
    scored = scored.join(F.broadcast(template_table(paragraphs.sparkSession)), "family", "left")
    overlap = F.array_max(F.transform("templates", lambda t: F.size(F.array_intersect(t, F.col("grams"))) / F.size(t)))
    confidence = 1 / (1 + F.exp(-(F.lit(model.slope) * F.col("odds") + model.intercept)))
    scored = scored.withColumn("overlap", F.coalesce(overlap, F.lit(0.0))).withColumn("confidence", confidence)
    sure = (F.col("confidence") >= 0.5) & (F.col("overlap") >= min_overlap)
    return scored.select(*keep, F.when(sure, F.col("family")).otherwise(UNKNOWN).alias("family"), "confidence", "overlap")


def scan(docs: DataFrame, model: LicenseModel | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_paragraphs``, ``n_candidates`` (paragraphs with a stem),
    ``n_license`` (paragraphs with a licence), ``families`` (sorted, comma-joined), ``family`` (of
    the surest paragraph, else unknown), ``first_line`` of a licence (from 1) and ``confidence``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    model = model or train(spark, rows)
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("text"))
    schema = ", ".join(f"{f.name} {'string' if f.name == 'text' else 'bigint'}" for f in _FOUND)
    # written once, as a second reading of the table need not give the same row numbers
    found = cut_lineage(numbered.mapInArrow(_candidates, schema), "license_pieces")
    judged = classify(found.where(F.col("paragraph").isNotNull()).select("row", "paragraph", "line", "text"), model)
    per_family = (judged.where(F.col("family") != UNKNOWN).groupBy("row", "paragraph", "family")
                  .agg(F.max_by("line", F.struct("overlap", "line")).alias("line"), F.max("confidence").alias("confidence"), F.max("overlap").alias("overlap")))
    best = F.max_by("family", F.struct("confidence", "overlap", -F.col("line")))
    per_row = per_family.groupBy("row").agg(   # a document's licence paragraphs
        F.count_distinct("paragraph").alias("n_license"), F.concat_ws(",", F.sort_array(F.collect_set("family"))).alias("families"),
        best.alias("family"), F.min("line").alias("first_line"), F.round(F.max("confidence"), 4).alias("confidence"))
    return found.where(F.col("paragraph").isNull()).select("row", "doc_id", "n_paragraphs", "n_candidates").join(per_row, "row", "left").select(
        "doc_id", "n_paragraphs", "n_candidates",
        F.coalesce("n_license", F.lit(0)).cast("long").alias("n_license"), F.coalesce("families", F.lit("")).alias("families"),
        F.coalesce("family", F.lit(UNKNOWN)).alias("family"), "first_line", "confidence")
