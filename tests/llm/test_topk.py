"""Exact top-k against all scores."""

import math

import numpy as np
import pytest
from compare import difference

from riskframe.llm import queries, topk

SMALL = "/root/testdata/sf0.001"


def by_force(rows, every, k):
    held = []
    for vec_id, v in rows:
        if vec_id is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        held.append((vec_id, [math.floor(1024 * float(np.float32(x))) for x in v]))
    out = []
    for i, (q, v) in enumerate(held):
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), c) for j, (c, w) in enumerate(held) if j != i and len(w) == len(v))
            out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(scores[:k])]
    return sorted(out)


def test_odd_vectors(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(0, 0.1, 8)]) for i in range(400)]
    rows += [(i, [0.25] * 8) for i in range(400, 700)]  # one common vector, so that scores tie
    rows += [(700, None), (None, [0.1] * 8), (701, [0.1, None] + [0.0] * 6), (702, [float("nan")] * 8),
             (800, [float("inf")] * 8), (900, [0.5] * 3), (901, [0.25] * 3), (1000, []), (1001, []), (5, [0.3] * 8), (5, [0.3] * 8),
             (10, [0.31] * 8), (10, [-0.2] * 8), (20, [0.25] * 8), (20, [0.25] * 8)]  # ids repeat, with equal and other vectors
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    df = df.selectExpr("*", "1 as rank", "'x' as shard")
    want = by_force(rows, 10, 7)
    monkeypatch.setattr(topk, "SHARD_ROWS", 150)
    assert sorted(tuple(r) for r in topk.top_k(df, every=10, k=7).collect()) == want
    monkeypatch.setattr(topk, "MOST_BOXES", 1)  # too many shards to send their boxes round
    assert sorted(tuple(r) for r in topk.top_k(df, every=10, k=7).collect()) == want


def test_the_other_row_of_an_id_is_a_candidate(spark):
    rows = [(0, [1.0, 0.0]), (5, [0.5, 0.0]), (5, [0.9, 0.0]), (7, [0.0, 1.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert [(r.rank, r.vec_id, r.score) for r in got.orderBy("rank").collect()] == [(1, 5, 921 * 1024), (2, 5, 512 * 1024), (3, 7, 0)]


def test_median_cuts_part_space_evenly():
    rng = np.random.default_rng(4)
    rows = rng.integers(-500, 500, (4000, 3))
    nodes = topk.median_cuts(rows, 8)
    assert np.bincount(topk.leaf_of(nodes, rows)).tolist() == pytest.approx([500] * 8, abs=60)
    same = np.full((100, 3), 7)
    assert set(topk.leaf_of(topk.median_cuts(same, 8), same).tolist()) == {0}


def test_a_tree_moves_once_and_far_shards_see_no_query(spark, monkeypatch):
    """Two far clusters: the queries of one do not reach the shards of the other, and no tree is sent twice."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in (1.0 if i % 2 else -1.0) + rng.normal(0, 0.05, 4)]) for i in range(800)]
    monkeypatch.setattr(topk, "SHARD_ROWS", 200)
    sent, search = [], topk._searched

    def spy(trees, queries, tasks, k):
        sent.append((trees.count(), trees.select("dim", "shard").distinct().count(), queries.count()))
        return search(trees, queries, tasks, k)

    monkeypatch.setattr(topk, "_searched", spy)
    got = sorted(tuple(r) for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), every=10).collect())
    assert got == by_force(rows, 10, 10)
    (trees, shards, home), (again, _, others) = sent
    assert trees == again == shards and home == 80 and others < 80 * (shards - 1) / 1.5


def test_no_vectors(spark):
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_a_query_alone_has_no_rows(spark):
    assert topk.top_k(spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")).count() == 0


def test_floors_prune_without_losing_anything():
    rng = np.random.default_rng(2)
    centres = rng.integers(-900, 900, (20, 6))
    rows = (centres[rng.integers(0, 20, 3000)] + rng.integers(-20, 20, (3000, 6))).astype(np.int64)
    tree = topk.build(np.arange(3000), rows)
    for q in rows[:40]:
        scores = sorted(((int(s), -i) for i, s in enumerate(rows @ q)), reverse=True)
        floor = scores[4]
        got = topk.search(tree, q[None, :], np.array([-1]), 10, [floor])
        assert sorted(((s, -i) for _, i, s in got), reverse=True) == scores[:4]


def test_equals_its_sql(spark):
    name = "op1_exact_top_k"
    assert difference(queries.QUERIES[name](spark, SMALL), queries.SQL[name], SMALL) is None


def test_scores_beyond_64_bits_are_refused():
    tree = topk.build(np.arange(2), np.full((2, 3), 1 << 40, np.int64))
    with pytest.raises(OverflowError):
        topk.search(tree, np.full((1, 3), 1 << 40, np.int64), np.array([9]), 1, [None])
