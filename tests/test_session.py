import os
import threading

import pytest

from riskframe import session
from riskframe.session import fresh_path, materialise, release, scratch


def written(df):
    return os.path.dirname(df.inputFiles()[0].removeprefix("file://"))


def test_scratch_deletes_all_but_what_is_kept(spark):
    before = materialise(spark.range(3), "before")
    with scratch(spark, "result"):
        step = materialise(before.selectExpr("id + 1 AS id"), "step")
        result = materialise(step.selectExpr("id * 2 AS id"), "result")
        gone = written(step)
    assert not os.path.exists(gone) and sorted(r.id for r in result.collect()) == [2, 4, 6]
    assert before.count() == 3


def test_what_an_inner_block_keeps_belongs_to_the_outer_one(spark):
    with scratch(spark, "result"):
        with scratch(spark, "half", "result"):
            half = materialise(spark.range(2), "half")
            result = materialise(half, "result")
        assert half.count() == 2
        gone = written(half)
    assert not os.path.exists(gone) and result.count() == 2


def test_a_failing_block_leaves_nothing(spark):
    made = []
    with pytest.raises(RuntimeError):
        with scratch(spark):
            made.append(written(materialise(spark.range(2), "half")))
            raise RuntimeError
    assert not os.path.exists(made[0])


def test_tables_of_another_thread_stay(spark):
    other = []
    with scratch(spark):
        worker = threading.Thread(target=lambda: other.append(materialise(spark.range(2), "theirs")))
        worker.start()
        worker.join()
    assert other[0].count() == 2


def test_release_deletes_what_is_left(spark, monkeypatch):
    monkeypatch.setattr(session, "_made", {})
    table = materialise(spark.range(2), "left")
    never_written = fresh_path(spark, "nothing")
    gone = written(table)
    assert release(spark) == 2 and not os.path.exists(gone) and not os.path.exists(never_written)
    assert release(spark) == 0
