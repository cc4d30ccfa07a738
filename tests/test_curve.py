"""The calibration curve's steps."""

import random
from types import SimpleNamespace

import pytest

from riskframe.plans import queries


def test_steps_of_a_curve_are_not_gathered_in_one_task(spark, monkeypatch):
    rng = random.Random(1)
    points = [(i / 500, min(1.0, i // 7 / 60)) for i in range(500)]
    cases = [(points, (True, True, True)), (points + [(0.5, 0.9)], (False, False, True)), ([(0.3, 0.2)], (True, True, True))]
    for rows, want in cases:
        rows = rng.sample(rows, len(rows))
        curve = spark.createDataFrame(rows, "x double, y double")
        monkeypatch.setattr(queries, "trained", lambda s, d: (SimpleNamespace(thresholds=lambda: curve), None, None))
        got = queries.calibrator_thresholds(spark, "unused")
        assert tuple(got.first()) == want
        assert "Window" not in got._jdf.queryExecution().executedPlan().toString()


def test_steps_equal_those_of_a_sorted_list(spark):
    rng = random.Random(2)
    points = sorted((rng.random(), rng.random()) for _ in range(300))
    got = sorted(tuple(r) for r in queries.joins.curve_steps(spark.createDataFrame(points, "x double, y double")).collect())
    assert got[0][2:] == (None, None) and len(got) == 300
    for (x, y, dx, dy), (x0, y0) in zip(got[1:], points):
        assert (dx, dy) == pytest.approx((x - x0, y - y0))
