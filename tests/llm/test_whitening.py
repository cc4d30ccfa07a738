"""Whitening against covariances in fractions and a plain eigendecomposition."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from riskframe.llm import queries, whitening

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, n double, x string"


def whole(vector):
    return [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in vector]


def by_force(rows, k=16):
    """n, {x: deviation}, covariance and its parts, from fractions."""
    good = [v for v in rows if v is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    xs = sorted({tuple(whole(v)) for v in good})
    n, d = len(xs), len(xs[0])
    sums = [sum(x[i] for x in xs) for i in range(d)]
    y = [[Fraction(n * x[i] - sums[i], n) for i in range(d)] for x in xs]
    v = np.array([[float(sum(r[i] * r[j] for r in y) / n) for j in range(d)] for i in range(d)])
    deviations = {x: sum((n * x[i] - sums[i]) ** 2 for i in range(d)) for x in xs}
    return n, sums, deviations, v


def vectors(rng, n, d=5):
    return [[rng.gauss(0, 1 + i) for i in range(d)] for _ in range(n)]


def test_odd_rows_against_fractions(spark):
    rng = random.Random(3)
    good = vectors(rng, 60)
    good += good[:7]  # repeated vectors count once for the fit
    odd = [None, [], [1.0, None, 0.0, 0.0, 0.0], [float("nan")] * 5, [float("inf"), 0.0, 0.0, 0.0, 0.0], [1.0, 2.0]]
    rows = [(i, v, 0.5, "extra") for i, v in enumerate(good + odd)] + [(None, good[0], None, None), (3, good[3], None, None)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    n, sums, deviations, v = by_force(good)
    values = -np.sort(-np.linalg.eigvalsh(v))
    assert {r.n for r in got} == {n} and len(got) == 5 * (len(good) + 2)
    at = {}
    for r in got:
        at.setdefault(r.vec_id, []).append(r)
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(v), rel=1e-9)
        assert r.identity_error < 1e-9
    assert len(at[3]) == 10 and len(at[None]) == 5 and set(at) == {*range(len(good)), None}
    for i, vector in enumerate(good):
        assert {r.deviation for r in at[i]} == {deviations[tuple(whole(vector))]}
    # distances of whitened vectors do not depend on the signs of the components
    white = {i: [{r.component: r.whitened for r in at[i]}[k] for k in range(1, 6)] for i in range(len(good))}
    inverse = np.linalg.inv(v)
    for i, j in [(0, 1), (5, 40), (11, 59)]:
        a = np.array(whole(good[i]), float) - np.array(whole(good[j]), float)
        assert sum((p - q) ** 2 for p, q in zip(white[i], white[j])) == pytest.approx(a @ inverse @ a, rel=1e-9)
    w = np.array([white[i] for i in range(60)])
    assert np.abs(w.T @ w / n - np.eye(5)).max() < 1e-9


def test_tables_without_a_spread(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    same = [(i, [0.1, 0.2], None, None) for i in range(5)]
    assert whitening.whiten(spark.createDataFrame(same, SCHEMA)).collect() == []
    line = [(i, [float(i), 2.0 * i], None, None) for i in range(5)]  # one direction only
    got = whitening.whiten(spark.createDataFrame(line, SCHEMA)).collect()
    assert {r.component for r in got} == {1} and all(r.explained == pytest.approx(1.0) for r in got)


def test_polarised_sums_give_the_exact_covariance(spark):
    rng = random.Random(5)
    rows = [([rng.randint(-10**9, 10**9) for _ in range(4)],) for _ in range(300)]
    table = spark.createDataFrame(rows, "x array<bigint>").repartition(5)
    sums = whitening.dimension_sums(table, 4)
    assert sums == [sum(r[0][i] for r in rows) for i in range(4)]
    squares = whitening.polarised_sums(table, 4, 300, sums)
    y = [[300 * x - s for x, s in zip(r[0], sums)] for r in rows]
    for a in range(4):
        for b in range(a + 1, 4):
            assert (squares[a, b] - squares[a, a] - squares[b, b]) == 2 * sum(r[a] * r[b] for r in y)


def test_sums_of_squares_of_any_size():
    rng = random.Random(7)
    for top in (10, 2**40, 2**61):
        values = [[rng.randint(-top, top) for _ in range(3)] for _ in range(50)]
        assert whitening.square_sums(np.array(values)) == [sum(r[i] ** 2 for r in values) for i in range(3)]


def test_values_beyond_64_bits_are_an_error(spark):
    far = [(1, [1e30, 0.0], None, None), (2, [0.0, 1.0], None, None)]
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(spark.createDataFrame(far, SCHEMA)).collect()


def test_query(spark):
    rows = queries.QUERIES["op13_embedding_whitening"](spark, SMALL).collect()
    table = {r.vec_id: list(r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()}
    assert len(rows) == 16 * len(table)
    x = np.array([whole(table[i]) for i in sorted(table)], float)
    v = np.cov(x.T, bias=True)
    values = -np.sort(-np.linalg.eigvalsh(v))
    for r in rows:
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(v), rel=1e-6)
    w = np.zeros((len(table), 16))
    for r in rows:
        w[sorted(table).index(r.vec_id), r.component - 1] = r.whitened
    assert np.abs(np.cov(w.T, bias=True) - np.eye(16)).max() < 1e-6
