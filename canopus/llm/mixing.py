"""Mixing sources to target token counts by entropy balancing.

Of all rates that give every source its target, those nearest to one copy of each document
in relative entropy (and at most ``max_copies``) are exponentially tilted ones: a document
of ``size`` tokens has the rate ``min(max_copies, exp(lambda * size / mean size))``. Each
source's ``lambda`` solves the convex dual, whose gradient is the source's tokens at these
rates less its target. Newton steps on the logarithm of that condition find it, kept inside
a bracket, all sources at once: an iteration is one aggregation by source.

A rate depends on the source and the size alone, so the iterations run over the counts of
(source, size), an exact summary of all documents whatever their number. Rates become
copies in the same summary: running sums by falling size are rounded, which keeps copies
near the rates at every size, and what a source then lacks or has too much (half its
largest document at most) is settled with single sizes that fit it best. Inside a
(source, size) the copies left over go to the documents that come first by a hash, found
by a distributed sort.

Sums are exact (integers and decimals), so reruns agree whatever the partitioning.

Defined results: a null or empty text has size 0 and one copy; null sources are one source,
the last; repeated rows are documents each; a source whose documents have no words has
target 0; one very long document is taken as often as fits its source's target best; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from canopus.operators.ranking import broadcast_if_small, with_global_index
from canopus.session import cut_lineage

from .common import words

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
#: Relative error of a source's tokens at the solved rates, and Newton steps at most (the bracket halves at worst).
TOLERANCE, MAX_STEPS = 1e-9, 100
#: Rates are used in units of 1e-9, so that running sums are exact.
UNIT = 1_000_000_000
MAX_SETTLING = 8


def _exact(c):
    return c.cast("decimal(38,8)")


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``(doc_id, source, size, key)``, written; the one pass over the texts."""
    text = F.col(text_col)
    return cut_lineage(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.size(words(text)).cast("long").alias("size"), F.xxhash64(F.col(id_col).cast("long"), text).alias("key")), "mix_rows")


def source_targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """``(place, source, documents, source_size, target)``: sources by code point, null last,
    weigh ``weights``, repeating, and share the sum of all sizes; a target stops at
    ``max_copies`` times its source's size and the excess goes to the others by weight. That
    is ``min(max_copies * size, level * weight)`` for the one level at which all is shared."""
    by_source = rows.groupBy("source").agg(F.count("*").alias("documents"), F.sum("size").alias("source_size"))
    placed, _ = with_global_index(by_source, [F.col("source").asc_nulls_last()], "place")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    placed = cut_lineage(placed.withColumn("weight", weight).withColumn("most", F.col("source_size") * max_copies), "mix_sources")
    total = placed.agg(F.sum("source_size").alias("s")).first()["s"] or 0
    level = 0.0
    while True:   # each round stops at least one more source
        stopped = F.col("most") <= F.lit(level) * F.col("weight")
        r = placed.agg(F.sum(F.when(stopped, F.col("most"))).alias("full"), F.sum(F.when(~stopped, F.col("weight"))).alias("open")).first()
        new = (total - (r["full"] or 0)) / r["open"] if r["open"] else level
        if new <= level:
            break
        level = new
    target = F.least(F.col("most").cast("double"), F.lit(level) * F.col("weight"))
    return cut_lineage(placed.select("place", "source", "documents", "source_size", target.alias("target")), "mix_targets")


def _rate(max_copies: int):
    tilted = F.least(F.lit(float(max_copies)), F.exp(F.col("tilt") * F.col("size") / F.col("scale")))
    return F.when(F.col("full") & (F.col("size") > 0), F.lit(float(max_copies))).otherwise(tilted)


def solve(cells: DataFrame, targets: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """``(place, full, scale, tilt)`` per source. ``cells`` is ``(place, size, n)``."""
    moment = cells.groupBy("place").agg(F.sum(_exact(F.col("n") * F.col("size")) * F.col("size")).alias("m2"))
    scale = F.greatest(F.col("source_size") / F.col("documents"), F.lit(1.0))
    full = F.col("target") >= F.col("source_size") * max_copies
    # a first guess: right if all documents had the size of the mean token's document
    guess = F.when(full | (F.col("target") <= 0), 0.0).otherwise(
        F.log(F.try_divide(F.col("target"), F.col("source_size"))) * scale * F.try_divide(F.col("source_size"), F.col("m2").cast("double")))
    state = cut_lineage(targets.join(moment, "place").select(
        "place", "target", full.alias("full"), scale.alias("scale"), F.coalesce(guess, F.lit(0.0)).alias("tilt"),
        F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"), full.alias("done")), "mix_state")
    for _ in range(MAX_STEPS):
        if state.where(~F.col("done")).limit(1).count() == 0:
            break
        rate = _rate(max_copies)
        tokens = F.col("n") * F.col("size") * rate
        slope = F.when(rate < max_copies, tokens * F.col("size") / F.col("scale")).otherwise(0.0)
        sums = (cells.join(state.where(~F.col("done")), "place").groupBy("place")
                .agg(F.sum(_exact(tokens)).cast("double").alias("tokens"), F.sum(_exact(slope)).cast("double").alias("slope")))
        error = F.log("tokens") - F.log("target")
        low = F.when(F.col("tokens") < F.col("target"), F.col("tilt")).otherwise(F.col("low"))
        high = F.when(F.col("tokens") > F.col("target"), F.col("tilt")).otherwise(F.col("high"))
        stepped = (state.join(sums, "place", "left").withColumn("low", low).withColumn("high", high)
                   .withColumn("step", F.col("tilt") - F.try_divide(error * F.col("tokens"), F.col("slope"))))
        inside = (F.col("step") > F.coalesce("low", F.lit(float("-inf")))) & (F.col("step") < F.coalesce("high", F.lit(float("inf"))))
        middle = (F.when(F.col("low").isNull(), F.col("high") * 2 - 1).when(F.col("high").isNull(), F.col("low") * 2 + 1)
                  .otherwise((F.col("low") + F.col("high")) / 2))
        hit = F.col("done") | F.coalesce(F.abs(F.col("tokens") - F.col("target")) <= TOLERANCE * F.col("target"), F.lit(True))
        state = cut_lineage(stepped.select(
            "place", "target", "full", "scale",
            F.when(hit, F.col("tilt")).when(F.coalesce(inside, F.lit(False)), F.col("step")).otherwise(middle).alias("tilt"),
            "low", "high", hit.alias("done")), "mix_state")
    return state.select("place", "full", "scale", "tilt")


def whole_copies(cells: DataFrame, targets: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """``cells`` (``place, size, n, rate``) with ``copies``, the whole number of copies of all
    documents of the cell."""
    part = (F.round(F.col("rate") * UNIT) * F.col("n")).cast("decimal(38,0)")
    upto = F.sum("part").over(Window.partitionBy("place").orderBy(F.desc("size")))   # a source's different sizes
    whole = lambda c: F.floor((c + UNIT // 2) / UNIT).cast("long")
    cells = cells.withColumn("part", part).withColumn("upto", upto)
    cells = cells.withColumn("copies", whole(F.col("upto")) - whole(F.col("upto") - F.col("part"))).drop("part", "upto")
    for _ in range(MAX_SETTLING):
        cells = cut_lineage(cells, "mix_cells")
        lack = (cells.groupBy("place").agg(F.sum(F.col("copies") * F.col("size")).alias("taken")).join(targets.select("place", "target"), "place")
                .select("place", (F.round("target").cast("long") - F.col("taken")).alias("lack")).where(F.col("lack") != 0))
        room = F.when(F.col("lack") > 0, F.col("n") * max_copies - F.col("copies")).otherwise(F.col("copies"))
        times = F.least(F.greatest(F.round(F.abs("lack") / F.col("size")).cast("long"), F.lit(1)), F.col("room"))
        best = (cells.where(F.col("size") > 0).join(lack, "place").withColumn("room", room).where(F.col("room") > 0)
                .withColumn("times", times).withColumn("rest", F.abs(F.abs("lack") - F.col("times") * F.col("size")))
                .where(F.col("rest") < F.abs("lack")).groupBy("place")
                .agg(F.min(F.struct("rest", "size", (F.col("times") * F.signum(F.col("lack"))).cast("long").alias("change"))).alias("b"))
                .select("place", F.col("b.size").alias("size"), F.col("b.change").alias("change")))
        best = cut_lineage(best, "mix_settling")
        if best.limit(1).count() == 0:
            break
        cells = cells.join(best, ["place", "size"], "left").withColumn("copies", F.col("copies") + F.coalesce("change", F.lit(0))).drop("change")
    return cut_lineage(cells, "mix_cells")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``(doc_id, size, source_size, target, taken, copies, rate)`` per document: its words, its
    source's words and target, the words the mix takes of it (``copies`` times its size) and
    the solved rate."""
    rows = sized(docs, id_col, text_col, source_col)
    targets = source_targets(rows, weights, max_copies)
    counts = rows.groupBy("source", "size").agg(F.count("*").alias("n"))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    named = targets.select("place", "source", "source_size", "target")
    cells = cut_lineage(counts.join(named, same(counts, named)).select("place", counts["source"], "source_size", "target", "size", "n"), "mix_counts")
    tilts = solve(cells.select("place", "size", "n"), targets, max_copies)
    rated = cells.join(tilts, "place").withColumn("rate", F.round(_rate(max_copies), 9))
    done = whole_copies(rated.select("place", "source", "source_size", "target", "size", "n", "rate"), targets, max_copies)
    order = [F.col("source").asc_nulls_last(), "size", "key", F.col("doc_id").asc_nulls_first()]
    ranked, _ = with_global_index(rows, order, "position")
    first = ranked.groupBy("source", "size").agg(F.min("position").alias("first"))
    done = done.join(first, same(done, first) & (done["size"] == first["size"])).select(
        done["source"], done["size"].alias("cell_size"), "source_size", "target", "n", "rate", F.col("copies").alias("of_cell"), "first")
    done = broadcast_if_small(cut_lineage(done, "mix_done"))   # checked bytes; else a join whose hot cells AQE splits
    extra = ((F.col("position") - F.col("first")) < F.col("of_cell") % F.col("n")).cast("long")
    copies = F.floor(F.col("of_cell") / F.col("n")).cast("long") + extra
    return (ranked.join(done, same(ranked, done) & (ranked["size"] == done["cell_size"]))
            .select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.alias("copies"), "rate"))
