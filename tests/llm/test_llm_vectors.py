"""Mixing, hard negatives and whitening against brute force, and their defined results for odd inputs."""

import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from canopus.llm import hard_negatives, mixing, queries, whitening

from .test_llm import CLASH, LONG, SF, words

SCHEMA = "vec_id bigint, embedding array<float>, label int"
ODD_VECTORS = [(1, None, 1), (2, [], 1), (3, [1.0, None, 0.0], 1), (4, [1.0, float("nan"), 0.0], 1), (5, [float("inf"), 0.0, 0.0], 2),
               (6, [1e30, 0.0, 0.0], 1), (7, [1.0, 0.0], 1), (None, [0.5, 0.5, 0.5], 1), (8, [0.5, 0.5, 0.5], None)]


def clashing(df, also=()):
    for c in (*CLASH, "x", "no", "pos", "score", "first", "block", "signs", "anchor", "place", "tilt", "copies", "rate", "size", "target", *also):
        if c not in df.columns:
            df = df.withColumn(c, F.lit("c"))
    return df


# ------------------------------------------------------------------ 11 mixing

def brute_targets(sizes: dict, weights=(5, 2, 1), most=3):
    """``sizes``: of each source. Shares are dealt out again until none is above its stop."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, fixed = {}, set()
    while len(fixed) < len(order):
        free = [s for s in order if s not in fixed]
        rest = sum(sizes.values()) - sum(most * sizes[s] for s in fixed)
        target |= {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if target[s] > most * sizes[s]]
        target |= {s: float(most * sizes[s]) for s in above}
        fixed |= set(above)
        if not above:
            break
    return target


def brute_rates(sizes, target, most=3):
    """The tilt by bisection."""
    sizes = np.array(sizes, float)
    if target >= most * sizes.sum():
        return np.where(sizes > 0, float(most), 1.0)
    scale, low, high = max(sizes.mean(), 1.0), -1e6, 1e6
    with np.errstate(over="ignore"):
        for _ in range(200):
            mid = (low + high) / 2
            rate = np.minimum(most, np.exp(mid * sizes / scale))
            low, high = (mid, high) if (rate * sizes).sum() < target else (low, mid)
    return rate


def check_mix(rows, texts):
    """``texts``: (doc_id, text, source) of all rows."""
    size = [(i, len(words(t)), s) for i, t, s in texts]
    of = collections.Counter()
    for _, n, s in size:
        of[s] += n
    target = brute_targets(of)
    assert len(rows) == len(texts)
    source = {(i, n): s for i, n, s in size}   # enough in these tables
    got = collections.defaultdict(list)
    for r in rows:
        s = source[r.doc_id, r.size]
        got[s].append(r)
        assert r.source_size == of[s] and math.isclose(r.target, target[s], rel_tol=1e-9, abs_tol=1e-9)
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
    for s, own in got.items():
        solved = brute_rates([r.size for r in own], target[s])
        assert np.allclose([r.rate for r in own], solved, atol=1e-6)
        taken = sum(r.taken for r in own)
        some = sorted(r.size for r in own if r.size)
        near = max(some[:1], default=0) if len(some) > 3 else some[-1] / 2 if some else 0   # few documents leave few sums
        assert abs(taken - target[s]) <= max(near, 0.01 * target[s], 1), (s, taken, target[s])


def test_mix(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check_mix(queries.op11_source_mixing(spark, SF).collect(), [tuple(r) for r in docs.select("doc_id", "text", "source").collect()])


def test_mix_reruns_agree_whatever_the_partitions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a, b = (sorted(map(tuple, mixing.mix(docs.repartition(n)).collect())) for n in (3, 7))
    assert a == b


def test_mix_odd_rows(spark):
    rows = ([(i, None, "b") for i in range(3)] + [(10, "", "b"), (11, " \n ", "b"), (12, LONG, "a"), (13, "one two", "a"), (13, "one two", "a")]
            + [(20 + i, "same text " * 4, "é") for i in range(12)] + [(40 + i, "w " * (i % 5 + 1), None) for i in range(30)] + [(None, "no id", "z")]
            + [(80 + i, "short " * (i + 1), "Z") for i in range(9)])
    df = clashing(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    out = mixing.mix(df)
    got = out.collect()
    assert len(got) == len(rows) and sum(r.size == 0 for r in got) == 5
    check_mix(got, rows)
    assert mixing.mix(df.limit(0)).count() == 0
    none = mixing.mix(df.where("source = 'b'")).collect()
    assert len(none) == 5 and all(r.taken == 0 and r.target == 0 for r in none)


def test_mix_settles_beside_one_large_document(spark):
    rows = [(0, "w " * 900, "a")] + [(i, "w " * 7, "a") for i in range(1, 60)] + [(100 + i, "w " * 11, "b") for i in range(80)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    check_mix(got, rows)


# ------------------------------------------------------------------ 12 hard negatives

def brute_negatives(rows, first=5, percent=80):
    use = [(i, lab, np.floor(256 * np.array(v, float)).astype(int)) for i, v, lab in rows]
    out = set()
    for a, la, x in use:
        if a % 100:
            continue
        score = [(int(x @ y), b, lb) for b, lb, y in use]
        key = lambda t: (-t[0], t[1])
        positives = sorted((t for t in score if t[2] == la and t[1] != a), key=key)[:first]
        for p, pid, _ in positives:
            fits = sorted((t for t in score if t[2] != la and percent * p <= 100 * t[0] <= 100 * p), key=key)[:first]
            out |= {(a, pid, k + 1, b, p, s) for k, (s, b, _) in enumerate(fits)}
    return out


def noisy(rows):
    return [(i, v, (lab + 1) % 10 if i % 7 == 0 else lab) for i, v, lab in rows]


def test_hard_negatives(spark):
    rows = noisy([(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()])
    got = [tuple(r) for r in queries.op12_hard_negatives(spark, SF).collect()]
    assert len(set(got)) == len(got) and set(got) == brute_negatives(rows)


@pytest.mark.parametrize("block,at_once,probe", [(512, 32_768, 32), (4, 8, 2), (1, 16, 1)])
def test_hard_negatives_close_vectors_and_ties(spark, block, at_once, probe):
    """Many equal scores, many anchors, trees of any size."""
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 1, (4, 6))
    rows = [(int(i), [float(v) for v in np.round(centres[i % 4] + rng.normal(0, 0.05, 6), 2 - (i % 2))], int(i // 3 % 3)) for i in range(0, 4000, 10)]
    rows += [(100 * k + 1, rows[0][1], k % 3) for k in range(5)]
    df = clashing(spark.createDataFrame(rows, SCHEMA))
    got = [tuple(r) for r in hard_negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, block=block, anchors_at_once=at_once, probe=probe).collect()]
    assert len(set(got)) == len(got) and set(got) == brute_negatives(rows)
    assert len({g[0] for g in got}) > 20


def test_bounds_leave_most_candidates_unscored():
    rng = np.random.default_rng(1)
    x = np.floor(256 * (np.repeat(rng.normal(0, 1, (8, 16)), 50, axis=0) + rng.normal(0, 0.02, (400, 16))))
    order, parent, edge = hard_negatives.spanning_tree(x[:50])
    tree = hard_negatives.Tree(0, np.arange(50), np.arange(50), x[:50][order], parent, edge)
    assert np.allclose(edge[1:], [np.linalg.norm(tree.x[k] - tree.x[p]) for k, p in enumerate(parent) if p >= 0])
    low = 0.9 * (x[0] @ x[0])
    found = {k: set(at.tolist()) for k, at, _ in hard_negatives.walk(tree, x, lambda k: (low, np.inf))}
    assert all(found[k] == set(np.flatnonzero(x @ tree.x[k] >= low).tolist()) for k in range(50))


def test_hard_negatives_odd_rows(spark):
    good = [(100 * i, [0.1 * i, 1.0, 0.2], i % 2) for i in range(1, 9)] + [(101, [0.3, 1.0, 0.1], 0), (101, [0.3, 1.0, 0.1], 0), (102, [-0.3, -1.0, 0.1], 1)]
    df = spark.createDataFrame(good + [(100 * i if i else i, v, lab) for i, v, lab in ODD_VECTORS], SCHEMA)
    got = collections.Counter(tuple(r) for r in hard_negatives.hard_negatives(df, F.col("vec_id") % 100 == 0).collect())
    assert set(got) == brute_negatives(good)
    twice = hard_negatives.hard_negatives(spark.createDataFrame(good[:8] * 2, SCHEMA), F.col("vec_id") % 100 == 0).collect()
    assert all(r.positive_id != r.anchor_id for r in twice) and {r["rank"] for r in twice} <= {1, 2, 3, 4, 5}
    assert hard_negatives.hard_negatives(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert hard_negatives.hard_negatives(spark.createDataFrame(ODD_VECTORS, SCHEMA), F.col("vec_id") % 100 == 0).count() == 0


# ------------------------------------------------------------------ 13 whitening

def check_whitening(rows, vectors, most=16):
    x = {i: np.floor(64 * np.array(v, float)).astype(int) + 1_000_000 for i, v in vectors}
    fit = np.unique(np.array(list(x.values())), axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = fit - s / n
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    k = int((e[:most] > 1e-10 * e[0]).sum())
    assert len(rows) == len(vectors) * k
    got = collections.defaultdict(dict)
    for r in rows:
        got[r.vec_id][r.component] = r
        assert r.n == n and r.deviation == int(((n * x[r.vec_id].astype(object) - s) ** 2).sum())
        assert math.isclose(r.explained, e[r.component - 1] / e.sum(), rel_tol=1e-9)
        assert r.identity_error <= 1e-9
    for j in range(k):
        want = {i: (y - s / n) @ u[:, j] / math.sqrt(e[j]) for i, y in x.items()}
        sign = np.sign(sum(got[i][j + 1].whitened * want[i] for i in x))
        assert max(abs(got[i][j + 1].whitened - sign * want[i]) for i in x) <= 1e-7


def test_whitening(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    check_whitening(queries.op13_embedding_whitening(spark, SF).collect(), [(r.vec_id, r.embedding) for r in rows])


def test_whitening_of_steep_and_of_flat_spectra(spark):
    rng = np.random.default_rng(2)
    for scale in (2.0 ** -np.arange(40) * 100, np.ones(40)):
        v = rng.normal(0, 1, (300, 40)) * np.maximum(scale, 0.02)
        rows = [(i, [float(a) for a in x]) for i, x in enumerate(v)]
        df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
        check_whitening(whitening.whiten(df).collect(), rows)


def test_whitening_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = [(100 + i, [float(a) for a in rng.normal(0, 1, 3)], 1) for i in range(20)]
    good += [(200 + i, good[0][1], 1) for i in range(5)]
    odd = [r for r in ODD_VECTORS if r[0] is not None and r[0] != 8]
    df = clashing(spark.createDataFrame(good + odd, SCHEMA), ("component", "cell", "col"))
    vectors = [(r.vec_id, r.embedding) for r in df.where("vec_id >= 100").collect()]   # as floats
    check_whitening(whitening.whiten(df).collect(), vectors)
    null = whitening.whiten(df.withColumn("vec_id", F.when(F.col("vec_id") < 110, None).otherwise(F.col("vec_id"))))
    assert null.where("vec_id is null").count() == 30
    assert whitening.whiten(df.limit(0)).count() == 0
    assert whitening.whiten(spark.createDataFrame(odd, SCHEMA).where("vec_id < 7")).count() == 0
    assert whitening.whiten(spark.createDataFrame([good[0]] * 3, SCHEMA)).count() == 0   # one distinct vector
    flat = [(i, [float(i), 2.0 * i, 5.0], 1) for i in range(12)]
    check_whitening(whitening.whiten(spark.createDataFrame(flat, SCHEMA)).collect(), [r[:2] for r in flat])


def test_deviations_beyond_64_bits():
    x = np.array([[3_000_000_000], [0]])
    assert whitening.deviations(x, 2, [3_000_000_000]) == [9_000_000_000_000_000_000, 9_000_000_000_000_000_000]
    assert whitening.deviations(x, 4, [3_000_000_000]) == [None, 9_000_000_000_000_000_000]
