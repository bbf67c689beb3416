"""Registered queries against their SQL, and the pipeline against brute force."""

import collections

import duckdb
import pytest

import corpus_pipeline
from canopus.llm import queries

from .test_llm import SF, brute_components, brute_contamination, brute_fingerprint, check_packing, words


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(queries.ORACLE_SQL[name]).fetchdf()
    got = queries.QUERIES[name](spark, SF).toPandas()
    cols = sorted(want.columns)
    assert cols == sorted(got.columns)
    assert collections.Counter(map(tuple, got[cols].values)) == collections.Counter(map(tuple, want[cols].values))


def test_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def base_fails(t):
    w = words(t)
    c = collections.Counter(zip(w, w[1:], w[2:]))
    return len(w) < 50 or 100 * len({p for k in range(len(w) - 2) if c[tuple(w[k:k + 3])] > 1 for p in (k, k + 1, k + 2)}) > 50 * len(w)


def test_pipeline(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    kept = {i: t for i, t in docs.items() if not base_fails(t)}   # no line is common in so few documents a host
    fps = {i: brute_fingerprint(t) for i, t in kept.items()}
    root, first = brute_components(fps.values()), {}
    for i, v in sorted(fps.items()):
        first.setdefault(root[v], i)
    kept = {i: kept[i] for i in first.values()}
    kept = {i: t for i, t in kept.items() if not brute_contamination(t, items)[4]}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(kept)
    bins, least = check_packing(rows, kept, 4096)
    assert bins <= least + 1


def test_stages_keep_columns_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
