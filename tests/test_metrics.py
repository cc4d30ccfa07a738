import random

import numpy as np
import pytest

from riskframe.operators import metrics, ranking


def scored(spark, pairs):
    rows = [(i, int(y), float(s)) for i, (y, s) in enumerate(pairs)]
    return spark.createDataFrame(rows, "TransactionID bigint, isFraud int, score double").repartition(3)


def brute_areas(pairs):
    pos = [s for y, s in pairs if y]
    neg = [s for y, s in pairs if not y]
    auc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    ap, tp, seen = 0.0, 0, 0
    for value in sorted({s for _, s in pairs}, reverse=True):
        here = [y for y, s in pairs if s == value]
        tp, seen = tp + sum(here), seen + len(here)
        ap += sum(here) / len(pos) * tp / seen
    return auc, ap


@pytest.mark.parametrize("digits", [1, 6])
def test_areas_with_plateaus_and_without(spark, digits):
    rng = random.Random(digits)
    pairs = []
    for i in range(600):
        y = rng.random() < 0.2
        pairs.append((y, 0.5 if i % 3 == 0 else round(min(1.0, rng.random() * (0.7 + 0.3 * y)), digits)))
    got = metrics.ranking_areas(scored(spark, pairs), range_rows=2).first()
    assert (got.roc_auc, got.average_precision) == pytest.approx(brute_areas(pairs), abs=1e-12)


def test_areas_without_both_classes(spark):
    one = metrics.ranking_areas(scored(spark, [(0, 0.1), (0, 0.2)])).first()
    assert one.roc_auc is None and one.average_precision is None and one.n == 2
    none = metrics.ranking_areas(scored(spark, [(1, 0.1)]).where("score > 1")).first()
    assert none.n == 0 and none.roc_auc is None


def test_review_queue_with_ties_at_the_edge(spark):
    pairs = [(i % 2, 0.9 if i < 3 else 0.5) for i in range(200)]
    got = sorted(ranking.review_queue(scored(spark, pairs)).collect())
    order = sorted(range(200), key=lambda i: (-pairs[i][1], i))
    for r, fraction in zip(got, [0.005, 0.01, 0.02, 0.05]):
        k = max(1, round(200 * fraction))
        tp = sum(pairs[i][0] for i in order[:k])
        assert tuple(r) == (fraction, k, tp, round(tp / k, 4), round(tp / 100, 4))


def test_review_queue_without_positives(spark):
    rows = ranking.review_queue(scored(spark, [(0, i / 10) for i in range(10)])).collect()
    assert all(r.recall is None and r.precision == 0.0 and r.n_reviewed == 1 for r in rows)


@pytest.mark.parametrize("n", [4, 7, 103])
def test_calibration_bins(spark, n):
    pairs = [(i % 3 == 0, (i * 7 % n) // 2 / n) for i in range(n)]
    got = {r.bin: r for r in ranking.calibration_table(scored(spark, pairs)).collect()}
    order = sorted(range(n), key=lambda i: (pairs[i][1], i))
    edges = np.linspace(0, n, 11).astype(int)
    for i in range(10):
        part = order[edges[i]:edges[i + 1]]
        if not part:
            assert i + 1 not in got
            continue
        assert got[i + 1]["count"] == len(part)
        assert got[i + 1].mean_predicted == pytest.approx(np.mean([pairs[j][1] for j in part]), abs=1e-6)
        assert got[i + 1].observed_rate == pytest.approx(np.mean([pairs[j][0] for j in part]), abs=1e-6)


def test_two_kinds_of_percentile(spark):
    values = [float(v) for v in random.Random(5).sample(range(1000), 101)]
    df = scored(spark, [(0, v) for v in values])
    assert ranking.interpolated_percentile(df, "score", 0.98) == (101, pytest.approx(np.percentile(values, 98)))
    assert ranking.nearest_rank(df, "score", [0.5, 0.95, 1.0]) == {
        0.5: sorted(values)[50], 0.95: sorted(values)[95], 1.0: max(values)}
    assert ranking.nearest_rank(df.where("score < 0"), "score", [0.5]) == {0.5: 0}


def test_policy_on_a_plateau_keeps_the_exact_cutoff(spark):
    policy = ranking.fit_review_policy(scored(spark, [(0, 0.1)] * 90 + [(1, 4 / 7)] * 10))
    assert policy["fitted_cutoff"] == 0.571429 and policy["exact_cutoff"] == 4 / 7
    realised = metrics.review_policy_metrics(scored(spark, [(1, 4 / 7), (0, 0.1)]), policy).first()
    assert (realised.n_reviewed, realised.review_rate, realised.precision, realised.recall) == (0, 0.0, None, 0.0)


def test_top_overlap_and_brier(spark):
    df = scored(spark, [(i % 2, i / 100) for i in range(100)]).selectExpr("*", "1 - score AS other")
    assert ranking.top_overlap(df, "score", "other").first().overlap == 0.0
    assert ranking.top_overlap(df, "score", "score").first().overlap == 1.0
    assert metrics.brier_score(df).first()[0] == pytest.approx(np.mean([(i / 100 - i % 2) ** 2 for i in range(100)]))


def test_stratified_sample_takes_all_of_a_small_class(spark):
    rows = [(i, int(i < 3), i * 10) for i in range(60)]
    df = spark.createDataFrame(rows, "TransactionID bigint, isFraud int, TransactionDT bigint")
    got = ranking.stratified_sample(df, n_rows=15, n_positive=5).collect()
    assert sorted(r.TransactionID for r in got if r.isFraud) == [0, 1, 2]
    want = (np.arange(3, 60)[np.linspace(0, 56, 10).astype(int)]).tolist()
    assert sorted(r.TransactionID for r in got if not r.isFraud) == want


def test_evaluate_is_one_row(spark):
    df = scored(spark, [(i % 4 == 0, i / 200) for i in range(200)])
    policy = ranking.fit_review_policy(df)
    row = metrics.evaluate(df, policy).collect()
    assert len(row) == 1 and row[0].holdout_n == 200
    assert [b.bin for b in row[0].calibration_table] == list(range(1, 11))
    assert [q.n_reviewed for q in row[0].review_queue] == [1, 2, 4, 10]


def test_areas_with_ranges_from_an_exchange(spark):
    rows = spark.range(500).selectExpr("cast(id * 37 % 90 as double) / 90 as score", "cast(id % 7 = 0 as int) as isFraud")
    listed = metrics.ranking_areas(rows).first()
    dealt = metrics.ranking_areas(rows, range_rows=10, most_ranges=1).first()
    assert (dealt.n, dealt.n_positive) == (listed.n, listed.n_positive)
    assert abs(dealt.roc_auc - listed.roc_auc) < 1e-12 and abs(dealt.average_precision - listed.average_precision) < 1e-12


def test_areas_of_two_scores_are_those_of_each(spark):
    rows = spark.range(400).selectExpr(
        "cast(id * 37 % 90 as double) / 90 as a", "if(id % 9 = 0, null, cast(id * 11 % 70 as double)) as b",
        "cast(null as double) as c", "cast(id % 7 = 0 as int) as isFraud")
    for options in ({}, {"range_rows": 10, "most_ranges": 1}):
        both = metrics.ranking_areas_of(rows, {"x": "a", "y": "b", "z": "c"}, **options).first()
        for name, column in (("x", "a"), ("y", "b"), ("z", "c")):
            alone = metrics.ranking_areas(rows, column).first()
            for got, want in zip(both[name], alone):
                assert got is want is None or got == pytest.approx(want, abs=1e-12)
    assert both["z"].n == 0 and both["z"].roc_auc is None
