import random

from pyspark.sql import functions as F
from rows import by_id, frame, row

from riskframe.operators.history import cut_into_ranges, time_since_previous

A, B = "time_since_prev_card1", "time_since_prev_card1_addr1"


def test_one_key(spark):
    df = frame(spark, row(TransactionID=1, TransactionDT=1000), row(TransactionID=2, TransactionDT=2500),
               row(TransactionID=3, TransactionDT=3000, card1=7), row(TransactionID=4, TransactionDT=9000))
    got = by_id(time_since_previous(df))
    assert [got[i][A] for i in (1, 2, 3, 4)] == [None, 1500.0, None, 6500.0]
    shuffled = by_id(time_since_previous(df.orderBy("M1", "TransactionDT", ascending=False)))
    assert {i: r[A] for i, r in got.items()} == {i: r[A] for i, r in shuffled.items()}


def test_two_keys_and_missing_as_a_key(spark):
    df = frame(spark, row(TransactionID=1, TransactionDT=1000), row(TransactionID=2, TransactionDT=1500, addr1=201.0),
               row(TransactionID=3, TransactionDT=4000), row(TransactionID=4, TransactionDT=5000, addr1=None),
               row(TransactionID=5, TransactionDT=5600, addr1=None))
    got = by_id(time_since_previous(df))
    assert [got[i][B] for i in range(1, 6)] == [None, None, 3000.0, None, 600.0]


def test_equal_times_follow_the_id(spark):
    df = frame(spark, *[row(TransactionID=i, TransactionDT=t) for i, t in ((3, 50), (1, 50), (2, 50), (4, 60))])
    got = by_id(time_since_previous(df))
    assert [got[i][A] for i in (1, 2, 3, 4)] == [None, 0.0, 0.0, 10.0]


def test_later_rows_change_nothing_earlier(spark):
    rows = [row(TransactionID=i, TransactionDT=i * 100, card1=i % 3) for i in range(12)]
    part = by_id(time_since_previous(frame(spark, *rows[:8])))
    whole = by_id(time_since_previous(frame(spark, *rows)))
    assert all(whole[i][A] == r[A] and whole[i][B] == r[B] for i, r in part.items())


def test_hot_keys_are_cut_and_nothing_changes(spark):
    rng = random.Random(3)
    rows = []
    for i in range(900):
        hot = i % 3 != 2
        card = (None if i % 2 else 1) if hot else rng.randrange(2, 60)
        time = 5000 if hot and i % 5 < 2 else rng.randrange(0, 20_000)
        rows.append(row(TransactionID=i * 3 + 1, TransactionDT=time, card1=card, addr1=rng.choice([None, 1.0, 2.0])))
    df = frame(spark, *rows).repartition(4)
    plain, cut = by_id(time_since_previous(df)), by_id(time_since_previous(df, hot_rows=25))
    assert len(cut) == 900
    assert all((cut[i][A], cut[i][B]) == (r[A], r[B]) for i, r in plain.items())
    last = {}
    for r in sorted(rows, key=lambda r: (r["TransactionDT"], r["TransactionID"])):
        before = last.get(r["card1"])
        assert plain[r["TransactionID"]][A] == (None if before is None else float(r["TransactionDT"] - before))
        last[r["card1"]] = r["TransactionDT"]


def test_sparse_ids_and_one_time_are_cut_evenly(spark):
    df = frame(spark, *[row(TransactionID=i * 10 ** 9, TransactionDT=7) for i in range(1, 1001)])
    cut = cut_into_ranges(df, "card1", 50)
    sizes = [r["count"] for r in cut.groupBy("_range").count().collect()]
    assert len(sizes) <= 2 * 1000 // 50 and max(sizes) <= 100
    got = by_id(time_since_previous(df, hot_rows=50))
    assert len(got) == 1000 and sorted(r[A] is None for r in got.values()) == [False] * 999 + [True]


def test_short_ranges_share_tasks_and_files(spark):
    """As many ranges as the rows ask for, but not a task and a file for each."""
    df = frame(spark, *[row(TransactionID=i, TransactionDT=i // 3, card1=i % 2) for i in range(2000)])
    cut = cut_into_ranges(df, "card1", 5)
    ranges = [(r.n, r.keys) for r in cut.groupBy("_range").agg(F.count("*").alias("n"), F.count_distinct("card1").alias("keys")).collect()]
    assert len(cut.inputFiles()) <= 4 and 400 <= len(ranges) <= 404 and max(n for n, _ in ranges) == 5
    plain, got = by_id(time_since_previous(df)), by_id(time_since_previous(df, hot_rows=5))
    assert all((got[i][A], got[i][B]) == (r[A], r[B]) for i, r in plain.items()) and len(got) == 2000
