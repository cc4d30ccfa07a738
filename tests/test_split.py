import random

import pytest

from riskframe.operators.split import TimeSplit, fit_time_split, split_record, split_sizes, split_summary


def rows_of(spark, times):
    data = [(i, t, int(i % 7 == 0)) for i, t in enumerate(times)]
    return spark.createDataFrame(data, "TransactionID bigint, TransactionDT bigint, isFraud int")


@pytest.mark.parametrize("n", [1000, 733])
def test_sizes_order_and_partition(spark, n):
    times = list(range(n))
    random.Random(n).shuffle(times)
    df = rows_of(spark, times)
    split = fit_time_split(df, buckets=16, fetch_rows=8)
    n_hold = round(n * 0.2)
    n_val = round((n - n_hold) * 0.1)
    assert (split.n_train, split.n_val, split.n_holdout) == (n - n_hold - n_val, n_val, n_hold)
    by = {r.split: r for r in split_summary(split.assign(df)).collect()}
    assert (by["train"].n_rows, by["val"].n_rows, by["holdout"].n_rows) == (split.n_train, n_val, n_hold)
    assert by["train"].last_time < by["val"].first_time
    assert by["val"].last_time < by["holdout"].first_time


def test_ties_on_both_cutoffs(spark):
    times = [10] * 400 + [20] * 300 + [30] * 300
    df = rows_of(spark, times)
    split = fit_time_split(df, buckets=16, fetch_rows=8)
    order = sorted((t, i) for i, t in enumerate(times))
    assert split.train_end == order[719] and split.pool_end == order[799]
    got = {r.TransactionID: r.split for r in split.assign(df).collect()}
    for pos, (_, i) in enumerate(order):
        assert got[i] == ("train" if pos < 720 else "val" if pos < 800 else "holdout")


def test_record_and_round_trip(spark):
    df = rows_of(spark, list(range(100)))
    split = fit_time_split(df)
    assert TimeSplit.from_dict(split.to_dict()) == split
    record = split_record(split, split.assign(df)).first()
    assert (record.holdout_cutoff_dt, record.val_cutoff_dt) == (79, 71)
    positives = len([i for i in range(72) if i % 7 == 0])
    assert record.positive_weight == pytest.approx((72 - positives) / positives)


def test_half_sizes_round_to_even():
    assert split_sizes(25, 0.5, 0.1) == (12, 1, 12)
