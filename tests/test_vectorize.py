"""TF-IDF stages (FIXTURES H3) and thresholds."""

import math

import pytest
from pyspark.sql import functions as F

from canopus.config import VectorizeConfig
from canopus.operators import vectorize as vz
from canopus.operators.ranking import with_global_index


def _docs(spark):
    return spark.createDataFrame([("d1", ["a", "a", "b"]), ("d2", ["b", "c"]), ("d3", ["b", "c", "c", "d"])],
                                 "doc_id string, tags array<string>")


def test_h3_tfidf(spark):
    st = vz.vectorize(_docs(spark), VectorizeConfig())
    assert {r["term"]: r["term_id"] for r in st.dictionary.collect()} == {"a": 0, "b": 1, "c": 2}
    assert st.n_docs == 3 and st.threshold == 2
    got = {(r["doc_id"], r["term_id"]): round(r["weight"], 6) for r in st.tfidf.collect()}
    assert got == {("d1", 0): 1.987628, ("d2", 2): 1.0, ("d3", 2): 1.414214}


def test_threshold_float32_truncation():
    assert vz.max_df_threshold(3, 99) == 2
    assert vz.max_df_threshold(958, 50) == 479
    assert vz.max_df_threshold(1, 99) == 0
    assert vz.max_df_percent_value(1000, 99, 2.0, 30.0) == 6


def test_threshold_column_matches_python(spark):
    df = spark.createDataFrame([(n, m) for n in (1, 3, 7, 958, 12345, 99999) for m in (1, 33, 50, 99)],
                               "n long, m long")
    for r in df.select("n", "m", vz.max_df_threshold_col(F.col("n"), F.col("m")).alias("t")).collect():
        assert r["t"] == vz.max_df_threshold(r["n"], r["m"])


def test_norms(spark):
    v = spark.createDataFrame([("x", 0, 3.0), ("x", 1, -4.0), ("y", 0, 0.0)], "doc_id string, term_id int, weight double")
    n2 = {(r["doc_id"], r["term_id"]): r["weight"] for r in vz.normalize(v, 2).collect()}
    assert n2[("x", 0)] == pytest.approx(0.6) and n2[("x", 1)] == pytest.approx(-0.8) and n2[("y", 0)] == 0.0
    ninf = {(r["doc_id"], r["term_id"]): r["weight"] for r in vz.normalize(v, "INF").collect()}
    assert ninf[("x", 1)] == pytest.approx(-1.0)
    n1 = {(r["doc_id"], r["term_id"]): r["weight"] for r in vz.normalize(v, 1).collect()}
    assert n1[("x", 0)] == pytest.approx(3 / 7)
    lg = {(r["doc_id"], r["term_id"]): r["weight"] for r in vz.normalize(v.where("weight > 0"), 2, log=True).collect()}
    assert lg[("x", 0)] == pytest.approx(math.log(4.0) / (math.log(2) * 3.0))
    with pytest.raises(ValueError):
        vz.normalize(v, "INF", log=True)
    with pytest.raises(ValueError):
        vz.normalize(v, 1, log=True)


def test_global_index_matches_row_number(spark):
    df = spark.range(0, 5000, 1, 7).select(F.md5(F.col("id").cast("string")).alias("k"))
    got, n = with_global_index(df, ["k"], "i")
    assert n == 5000
    exp = sorted(r["k"] for r in df.collect())
    assert [r["k"] for r in got.orderBy("i").collect()] == exp
    assert sorted(r["i"] for r in got.collect()) == list(range(5000))


def test_smooth_scheme(spark):
    st = vz.vectorize(_docs(spark), VectorizeConfig(scheme="smooth"))
    got = {(r["doc_id"], r["term_id"]): r["weight"] for r in st.tfidf.collect()}
    assert got[("d1", 0)] == pytest.approx(2 * math.log(4 / 2))


def test_only_rows_of_rare_terms_are_shuffled_past_a_large_dictionary(spark, monkeypatch):
    from canopus.operators import ranking
    words = [f"t{i:02d}" for i in range(40)]
    dt = spark.createDataFrame([(f"d{d}", w, 1 + d % 3) for d in range(64) for i, w in enumerate(words) if d % (i + 1) == 0], "doc_id string, term string, tf int")
    dictionary, n = vz.build_dictionary(vz.term_counts(dt), 3)
    key = lambda df: sorted(tuple(r) for r in df.collect())
    want = key(vz.term_frequency(dt, dictionary))
    df = vz.document_frequency(vz.term_frequency(dt, dictionary))
    kept = key(vz.prune_by_df(vz.term_frequency(dt, dictionary), df, 2, 50))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for room in (n * 20, 1):   # some terms' room, and no room
            monkeypatch.setattr(ranking, "BROADCAST_BYTES", room)
            tf = vz.term_frequency(dt, dictionary)
            assert ("BroadcastHashJoin" in tf._jdf.queryExecution().executedPlan().toString()) == (room > 1)
            assert key(tf) == want and key(vz.prune_by_df(tf, df, 2, 50)) == kept
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_terms_are_counted_without_a_shuffle_and_repeated_ids_are_pooled(spark, monkeypatch):
    monkeypatch.setattr(vz, "PACK_TAGS", 3)
    rows = [("d1", ["b", "a", "b"]), ("d2", ["é", "z", None, "a"]), (None, ["a"]), ("d3", []), ("d4", None), ("d1", ["b", "c"]), (None, ["a", "q"]), ("d5", ["z"])]
    docs = spark.createDataFrame(rows, "doc_id string, tags array<string>").repartition(3)
    key = lambda df: sorted((str(r[0]), *r[1:]) for r in df.collect())
    want = key(vz.doc_terms(docs))
    st = vz.vectorize(docs, VectorizeConfig(min_support=1))
    assert key(st.doc_terms) == want and ("d1", "b", 3) in want and ("None", "a", 2) in want
    assert key(st.term_counts) == key(vz.term_counts(vz.doc_terms(docs)))
    assert key(st.df) == key(vz.document_frequency(st.tf)) and st.n_docs == 4 and st.n_features == 6
    counted = docs.mapInArrow(vz._count_tags, "doc_id string, terms array<string>, tfs array<int>")
    assert "hashpartitioning" not in counted._jdf.queryExecution().executedPlan().toString()
    one = vz.vectorize(docs.where("doc_id IN ('d2', 'd5')"), VectorizeConfig(min_support=1))   # no id twice: counts are read as written
    assert "hashpartitioning" not in one.doc_terms._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in one.pruned._jdf.queryExecution().executedPlan().toString()
