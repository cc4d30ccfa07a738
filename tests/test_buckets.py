"""Tables in buckets by id join where they lie."""

import pytest

from riskframe.operators import joins
from riskframe.session import fresh_path
from riskframe.sources import buckets


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _stored(spark, n, schema, row, again=True):
    path = fresh_path(spark, "bucketed")
    made = buckets.store_bucketed(spark.createDataFrame([row(i) for i in range(n)], schema).repartition(3), path, 4)
    return buckets.read_bucketed(spark, path) if again else made


def _exchanges(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


@pytest.mark.parametrize("again", [True, False])
def test_joins_by_id_move_no_row(spark, no_broadcast, again):
    tx = _stored(spark, 40, "TransactionID bigint, `a b` string", lambda i: (i, f"t{i}"), again)
    idn = _stored(spark, 40, "TransactionID bigint, id_01 double", lambda i: (3 * i, float(i)), again)
    joined = joins.join_identity(tx, idn)
    assert _exchanges(joined) == 0
    assert sorted((r.TransactionID, r["a b"], r.id_01) for r in joined.collect()) == [
        (i, f"t{i}", float(i // 3) if i % 3 == 0 else None) for i in range(40)]
    assert _exchanges(joins.duplicate_keys(tx)) == 0


def test_comparison_of_stored_scores_moves_no_row(spark, no_broadcast):
    schema = "TransactionID bigint, score double, review_flag boolean"
    left = _stored(spark, 30, schema, lambda i: (i, i / 30, i > 20))
    right = _stored(spark, 30, schema, lambda i: (i + 5, (i + 5) / 30, i + 5 > 20))
    compared = joins.compare_scores(left, right)
    assert _exchanges(compared) == 0
    assert joins.comparison_summary(compared).first().n_mismatches == 10


def test_replaced_and_forgotten(spark):
    path = fresh_path(spark, "bucketed")
    buckets.store_bucketed(spark.range(10).withColumnRenamed("id", "TransactionID"), path, 2)
    buckets.store_bucketed(spark.range(20).withColumnRenamed("id", "TransactionID"), path, 4)
    assert buckets.read_bucketed(spark, path).count() == 20
    assert buckets.forget_tables(spark) >= 3 and buckets.forget_tables(spark) == 0
    assert buckets.read_bucketed(spark, path).count() == 20
