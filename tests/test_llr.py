"""Log-likelihood ratio against the entropy form computed in plain Python."""

import collections
import math
import random

import pytest

from canopus.functions.llr import llr
from canopus.operators.ngrams import accepted_ngrams, llr_scores, may_be_kept, ngram_tokens


def _xlogx(x):
    return 0.0 if x == 0 else x * math.log(x)


def _g2(k11, k12, k21, k22):
    h = lambda *xs: _xlogx(sum(xs)) - sum(_xlogx(x) for x in xs)
    return max(0.0, 2 * (h(k11 + k12, k21 + k22) + h(k11 + k21, k12 + k22) - h(k11, k12, k21, k22)))


def test_llr_matches_entropy_form(spark):
    from pyspark.sql import functions as F
    cases = [(10, 0, 0, 1000), (1, 1, 1, 1), (3, 7, 11, 5000), (0, 5, 5, 10), (110, 2442, 111, 29114)]
    df = spark.createDataFrame(cases, "a long, b long, c long, d long")
    got = [r["g"] for r in df.select(llr(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("g")).collect()]
    for (a, b, c, d), g in zip(cases, got):
        assert g == pytest.approx(_g2(a, b, c, d), rel=1e-9, abs=1e-9)


def test_bigram_contingency(spark):
    docs = spark.createDataFrame([("1", ["new", "york", "city"]), ("2", ["new", "york"]), ("3", ["old", "york"])],
                                 "doc_id string, tags array<string>")
    s = {r["gram"]: r for r in llr_scores(docs, 2).collect()}
    ny = s["new york"]
    # T = 4 bigrams; head 'new' twice, tail 'york' three times
    assert (ny["k11"], ny["k12"], ny["k21"], ny["k22"]) == (2, 0, 1, 1)


def _tag_docs(spark, rows=200, words=30):
    rng = random.Random(3)
    made = [(str(i), rng.choices([f"t{k}" for k in range(words)], k=rng.randrange(12))) for i in range(rows)]
    made += [("hot", ["new", "york", "city"] * 300), ("none", None), ("empty", []), ("one", ["new"]), ("two", ["new", "york"]),
             ("two", ["new", "york"]), ("three", ["new", "york", None, "city"])]
    return spark.createDataFrame(made, "doc_id string, tags array<string>"), made


def test_all_sizes_in_one_pass_equal_each_size(spark):
    docs, _ = _tag_docs(spark)
    together = sorted(map(tuple, llr_scores(docs, 2, 4).collect()))
    assert together == sorted(tuple(r) for n in (2, 3, 4) for r in llr_scores(docs, n).collect())


@pytest.mark.parametrize("bytes_", [0, 64 << 20])
def test_accepted_occurrences_by_broadcast_and_by_filter(spark, bytes_):
    docs, made = _tag_docs(spark)
    kept = {r["gram"] for r in accepted_ngrams(docs, 3, 3, 4.0).collect()}
    assert {"new york", "new york city"} <= kept
    want = collections.Counter()
    for i, tags in made:
        for n in (2, 3):
            for k in range(len(tags or []) - n + 1):
                gram = " ".join(t for t in tags[k:k + n] if t is not None)
                if gram in kept:
                    want[i, gram] += 1
    got = collections.Counter()
    for r in ngram_tokens(docs, 3, 3, 4.0, bytes_).collect():
        got[r["doc_id"], r["term"]] += r["tf"]
    assert got == want


def test_filter_keeps_every_accepted_gram_and_few_others(spark):
    grams = spark.range(40_000).selectExpr("concat('g ', id) AS gram")
    kept = grams.where("gram < 'g 2'").cache()   # about a quarter
    passed = {r["gram"] for r in may_be_kept(grams, kept).collect()}
    mine = {r["gram"] for r in kept.collect()}
    assert mine <= passed
    assert len(passed - mine) < 0.06 * (40_000 - len(mine))
    assert may_be_kept(grams, kept.limit(0)).count() == 0


def test_scores_of_frequent_grams_need_only_frequent_heads_and_tails(spark, monkeypatch):
    """Rare heads and tails are never joined, and a large table of them is not shuffled against all grams."""
    from canopus.operators import ngrams as ng
    from canopus.operators import ranking
    docs = spark.createDataFrame([(f"d{i}", [f"t{(i * j) % 7}" for j in range(1, 12)] + [f"rare{i}"]) for i in range(30)], "doc_id string, tags array<string>")
    key = lambda df: sorted((r["gram"], r["k11"], r["k12"], r["k21"], r["k22"], round(r["llr"], 9)) for r in df.collect())
    want = [r for r in key(ng.llr_scores(docs, 2, 3)) if r[1] >= 4]
    seen = []
    join = ng.lookup_join
    monkeypatch.setattr(ng, "lookup_join", lambda rows, table, keys, freq: seen.append(table.where(freq < 4).count()) or join(rows, table, keys, freq))
    assert key(ng.llr_scores(docs, 2, 3, 4)) == want and want and seen == [0, 0]
    monkeypatch.setattr(ranking, "BROADCAST_BYTES", 400)
    assert key(ng.llr_scores(docs, 2, 3, 4)) == want


def _joined(tags):
    return " ".join(t for t in tags if t is not None)


def test_hashes_of_joined_strings_follow_from_their_parts(spark):
    import numpy as np
    import pyarrow as pa

    from canopus.operators import ngrams as ng
    docs = [["ab", None, "c d", "", "é"], [], None, [None, "x", "x"], ["x"], ["a b", "c"], ["a", "b c"]]
    batch = pa.RecordBatch.from_pydict({"tags": pa.array(docs, pa.list_(pa.string()))})
    run = ng.TagRun(batch.slice(1))   # a slice, as tasks see it
    for n in (2, 3):
        at = run.longer()
        flat = [(r, t) for r, tags in enumerate(docs[1:]) for t in tags or []]
        want = [[t for _, t in flat[i:i + n]] for i in range(len(flat)) if i + n <= len(flat) and flat[i][0] == flat[i + n - 1][0]]
        assert run.strings([run.code[at + k] for k in range(n)]).to_pylist() == [_joined(w) for w in want]
        assert (run.joined == ng.string_hashes(pa.array([_joined(w) for w in want]))[0]).all()
        there = np.array([w[-1] is not None for w in want])
        assert (run.scored[there] == ng.string_hashes(pa.array([f"{_joined(w[:-1])} {w[-1]}" for w in want if w[-1] is not None]))[0]).all()


def test_rare_grams_are_not_shuffled(spark, monkeypatch):
    """A sieve keeps what is rarer than the support from being counted by strings; the scores stay the same."""
    from canopus.operators import ngrams as ng
    docs, _ = _tag_docs(spark)
    monkeypatch.setattr(ng, "RUN_TAGS", 50)
    docs = docs.repartition(3)
    key = lambda df: sorted(tuple(r) for r in df.collect())
    want = [r for r in key(ng.llr_scores(docs, 2, 3)) if r[4] >= 6]
    assert key(ng.llr_scores(docs, 2, 3, 6)) == want and want
    rare = docs.selectExpr("doc_id", "transform(tags, (t, i) -> concat(t, doc_id, '_', i)) AS tags").unionByName(docs.where("doc_id = 'hot'"))
    counted = ng.gram_counts(rare, 2, 3, ng.frequent_hashes(rare, 3, 6))
    assert counted.where(f"kind = {ng.GRAM}").count() < 20 < ng.gram_counts(rare, 2, 3).where(f"kind = {ng.GRAM}").count()


@pytest.mark.parametrize("most", [1_000_000, -1])
def test_terms_and_accepted_grams_are_packed_where_the_tags_are(spark, monkeypatch, most):
    """Without a shuffle by document and term; by rows if too many grams look accepted."""
    from canopus.config import VectorizeConfig
    from canopus.operators import ngrams as ng
    from canopus.operators import vectorize as vz
    docs, _ = _tag_docs(spark)
    docs = docs.unionByName(spark.createDataFrame([("x", ["new york", "city", "new", "york"]), ("y", ["", "new", None, "york", "city"])], docs.schema))
    cfg = VectorizeConfig(min_support=3, max_ngram=3, min_llr=4.0)
    key = lambda df: sorted(tuple(r) for r in df.collect())
    want = key(vz.doc_terms(docs, cfg))
    monkeypatch.setattr(ng, "MAX_FALSE", most)
    monkeypatch.setattr(vz, "PACK_TAGS", 40)
    st = vz.vectorize(docs, cfg)
    assert key(st.doc_terms) == want and ("x", "new york", 2) in want
    assert ("Exchange" in vz.vectorize(docs.where("doc_id > '5'"), cfg).doc_terms._jdf.queryExecution().executedPlan().toString()) is False
    assert key(st.df) == key(vz.document_frequency(st.tf))
