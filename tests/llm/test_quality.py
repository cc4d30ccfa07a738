"""Positive-unlabelled quality: the risk's gradient, the prior, held-out quality, odd rows."""

import numpy as np
import pytest

from riskframe.llm import quality, queries

SMALL = "/root/testdata/sf0.01"


def test_gradient_of_the_risk_and_the_step_back():
    rng = np.random.default_rng(1)
    positive = np.arange(30) < 12
    for shift in (0.0, -6.0):  # the second makes the risk of unlabelled texts negative
        z = rng.normal(0, 1, 30) + np.where(positive, -shift, shift)

        def risk(z):
            p = quality._sigmoid(z)
            bad = p[~positive].mean() - 0.6 * p[positive].mean()
            if bad < 0:
                return -bad
            return 0.6 * (1 - p[positive]).mean() + bad

        got = quality.risk_gradient(z, positive, 0.6)
        for i in range(30):
            up, down = z.copy(), z.copy()
            up[i] += 1e-6
            down[i] -= 1e-6
            assert got[i] == pytest.approx((risk(up) - risk(down)) / 2e-6, abs=1e-6)


def test_prior_of_a_known_mixture():
    rng = np.random.default_rng(2)
    for share in (0.3, 0.8):
        positive = rng.normal(2, 1, 3000)
        good = rng.random(4000) < share
        unlabelled = np.where(good, rng.normal(2, 1, 4000), rng.normal(-2, 1, 4000))
        assert quality.estimate_prior(positive, unlabelled) == pytest.approx(share, abs=0.06)


def test_held_out_quality_and_columns(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    got = queries.QUERIES["op5_quality_classifier"](spark, SMALL)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([p == y for p, y in held]) > 0.93
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)


def test_bad_labels_and_columns_are_not_used(spark):
    rows = [(i, "Good words in a row. And more of them." if i % 3 else "|| ## @@ !!") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    told = lambda bad: spark.createDataFrame([(i, 1 if i % 3 else bad) for i in range(0, 200, 2)], "doc_id long, quality int")
    a = quality.quality(docs, told(0)).collect()
    b = quality.quality(docs.selectExpr("*", "'x' as lang", "2 as score"), told(None)).collect()
    assert sorted(a) == sorted(b)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "a"), (3, "b " * 30000)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.quality(docs, none).count() == 5
    assert quality.quality(docs.limit(0), none).count() == 0
    odd = spark.createDataFrame([(1, 1), (1, 1), (2, None), (7, 0), (None, 1)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in quality.quality(docs, odd).collect())
