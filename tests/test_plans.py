"""The shape of physical plans: what must not appear in them."""

import re

from pyspark.sql import functions as F

from riskframe.operators import encode, metrics, ranking
from riskframe.operators.history import time_since_previous
from riskframe.operators.split import fit_time_split
from riskframe.plans import features as feat
from riskframe.sources import views

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return re.findall(r"(?<!Broadcast)Exchange (\w+)", plan(df))


def test_both_histories_share_one_exchange(spark):
    tx = views.transactions(spark, DATA)
    assert exchanges(time_since_previous(tx).select("TransactionID", "time_since_prev_card1", "time_since_prev_card1_addr1")) == ["hashpartitioning"]


def test_slices_are_a_projection(spark):
    tx = views.transactions(spark, DATA)
    assert exchanges(fit_time_split(tx).assign(tx)) == []


def test_applying_encodings_moves_no_row(spark):
    rows = feat.row_features(views.transactions(spark, DATA))
    fitted = encode.fit_encodings(rows)
    applied = encode.apply_encodings(rows, fitted)
    text = plan(applied)
    assert "SortMergeJoin" not in text and "NestedLoop" not in text
    assert text.count("BroadcastHashJoin") >= 7


def test_large_maps_cost_one_shuffle_join_each(spark):
    rows = feat.row_features(views.transactions(spark, DATA))
    fitted = encode.fit_encodings(rows)
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    applied = encode.apply_encodings(rows, fitted, broadcast_rows=0, hot_rows=20)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # so that only what the code asks for is broadcast
    try:
        assert plan(applied.select("*")).count("SortMergeJoin") == 7
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the hot keys of all six key sets come from one sample: its write and count, and a write for each set
    assert len(set(tracker.getJobIdsForGroup(None)) - before) <= 3 * 7


def test_reports_move_only_partial_sums(spark):
    rows = views.scored(spark, DATA)
    assert exchanges(ranking.review_queue(rows)) == ["SinglePartition"]
    assert "HashAggregate(keys=[], functions=[partial_count" in plan(ranking.review_queue(rows)).replace("\n", "")
    assert exchanges(ranking.calibration_table(rows)) == ["hashpartitioning"]
    areas = plan(metrics.ranking_areas(rows))
    assert "partial_sum" in areas and "NestedLoop" not in areas and "CartesianProduct" not in areas


def test_scan_reads_only_what_is_used(spark):
    text = plan(views.transactions(spark, DATA).select("TransactionID", "card1").where(F.col("card1") > 5))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in text
    assert "GreaterThan(user_id,5)" in text
