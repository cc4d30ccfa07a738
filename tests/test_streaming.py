"""Streams against the same operators on whole tables."""

import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from rows import frame, row

from riskframe.operators.encode import apply_encodings, fit_encodings
from riskframe.operators.history import time_since_previous
from riskframe.operators.monitor import drift_record
from riskframe.plans import queries
from riskframe.plans.features import row_features
from riskframe.session import fresh_path
from riskframe.streaming.drift import response_counts, start_counting, window_records
from riskframe.streaming.history import _History, start_history, stream_history
from riskframe.streaming.route import read_routed, start_routing, write_batch

A, B = "time_since_prev_card1", "time_since_prev_card1_addr1"


def _rows(n, seed=1):
    rng = random.Random(seed)
    times = sorted(rng.randrange(100_000, 103_000) for _ in range(n))
    return [row(TransactionID=i, TransactionDT=t, card1=rng.choice([1, 2, 3, None]), addr1=rng.choice([1.0, None]))
            for i, t in enumerate(times)]


def _feed(spark, source, rows):
    frame(spark, *rows).coalesce(1).write.mode("append").parquet(source)


def _run(spark, source, sink, state, **options):
    stream = spark.readStream.schema(frame(spark).schema).option("maxFilesPerTrigger", 1).parquet(source)
    start_history(stream_history(stream, carry=["ProductCD"], **options), sink, state).awaitTermination()


def _found(df):
    return {r.TransactionID: (r[A], r[B]) for r in df.collect()}


def test_history_over_three_batches_and_a_restart(spark):
    rows = _rows(240)
    source, sink, state = (fresh_path(spark, n) for n in ("in", "out", "state"))
    for part in (rows[:60], rows[60:150]):
        _feed(spark, source, part)
    _run(spark, source, sink, state)
    _feed(spark, source, rows[150:])
    _run(spark, source, sink, state)
    got = read_routed(spark, sink, "rows")
    assert got.select("batch").distinct().count() == 3 and "ProductCD" in got.columns
    assert _found(got) == _found(time_since_previous(frame(spark, *rows))) and got.count() == 240
    assert read_routed(spark, sink, "late").count() == 0


def test_late_rows_are_turned_away_and_change_nothing(spark):
    source, sink, state = (fresh_path(spark, n) for n in ("in", "out", "state"))
    _feed(spark, source, [row(TransactionID=1, TransactionDT=1000), row(TransactionID=2, TransactionDT=2000)])
    # 3: before its card's last row, though within the watermark's delay; 4: another card, in time; 5: before the watermark
    _feed(spark, source, [row(TransactionID=3, TransactionDT=1900), row(TransactionID=4, TransactionDT=1950, card1=7),
                          row(TransactionID=5, TransactionDT=1500, card1=8), row(TransactionID=6, TransactionDT=2100)])
    _run(spark, source, sink, state, lateness=100)
    assert _found(read_routed(spark, sink, "rows")) == {1: (None, None), 2: (1000.0, 1000.0), 4: (None, None), 6: (100.0, 100.0)}
    late = read_routed(spark, sink, "late")
    assert {r.TransactionID for r in late.collect()} == {3, 5} and A not in late.columns


def test_idle_cards_are_forgotten(spark):
    source, sink, state = (fresh_path(spark, n) for n in ("in", "out", "state"))
    for batch in ([(1, 1000, 5), (2, 1000, 6)], [(3, 1400, 6)], [(4, 1600, 9)], [(5, 1700, 5), (6, 1700, 6)]):
        _feed(spark, source, [row(TransactionID=i, TransactionDT=t, card1=c) for i, t, c in batch])
    _run(spark, source, sink, state, forget_after=500)
    got = _found(read_routed(spark, sink, "rows"))
    assert got[5] == (None, None)  # idle for 700 seconds
    assert got[6] == (300.0, 300.0) and got[3] == (400.0, 400.0)


def test_a_replayed_or_unfinished_batch_writes_nothing_twice(spark):
    sink = fresh_path(spark, "routed")
    parts = lambda k: {"a": spark.createDataFrame([(k,)], "k int"), "b": spark.createDataFrame([(10 * k,), (10 * k,)], "k int")}
    for batch in (0, 1, 1, 0):
        write_batch(parts(batch), sink, batch)
    spark.createDataFrame([(99,)], "k int").write.parquet(f"{sink}/a/batch=2")  # lost before its commit
    assert sorted(r.k for r in read_routed(spark, sink, "a").collect()) == [0, 1]
    write_batch(parts(2), sink, 2)
    assert sorted(r.k for r in read_routed(spark, sink, "a").collect()) == [0, 1, 2] and read_routed(spark, sink, "b").count() == 6


@pytest.mark.parametrize("seed", [1, 2])
def test_windows_of_the_log_equal_the_record_of_their_slice(spark, seed):
    rng = random.Random(seed)
    rows = [(i, t, int(rng.random() < 0.3), None if rng.random() < 0.02 else round(rng.random(), 2), float(rng.randint(90, 99)))
            for i, t in enumerate(sorted(rng.randrange(0, 4000) for _ in range(500)))]
    rows += [(900, 4000, 1, 0.5, 95.0), (901, 6500, 0, 0.5, 95.0)]  # a window with one class, one that stays open
    schema = "TransactionID bigint, TransactionDT bigint, isFraud int, calibrated_probability double, elapsed_ms double"
    log = spark.createDataFrame(rows, schema)
    source, sink, state = (fresh_path(spark, n) for n in ("in", "out", "state"))
    for low, high in ((0, 1500), (1500, 2500), (2500, 9000)):
        log.where(f"TransactionDT >= {low} AND TransactionDT < {high}").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(source)
    start_counting(response_counts(stream, 1000), sink, state).awaitTermination()
    got = window_records(read_routed(spark, sink, "counts"), 0.5).orderBy("window_from").collect()
    assert [r.window_from for r in got] == [0, 1000, 2000, 3000, 4000]
    for r in got:
        want = drift_record(log.where((F.floor(F.col("TransactionDT") / 1000) * 1000) == r.window_from), 0.5).first()
        for c in ("n", "observed", "match", "p50_ms", "p95_ms", "errors", "duration_s"):
            assert r[c] == want[c], (r.window_from, c)


def test_a_further_key_is_asked_for_and_written_once_a_batch():
    class State(dict):
        calls = 0

        def containsKey(self, key):
            self.calls += 1
            return key in self

        def getValue(self, key):
            return self[key]

        def updateValue(self, key, value):
            self.calls += 1
            self[key] = value

    class Last:
        value = (50, 0)
        exists = lambda self: True
        get = lambda self: self.value
        update = lambda self, value: setattr(self, "value", value)

    clock = type("Clock", (), {"getCurrentWatermarkInMs": lambda self: 0})()
    step = _History({A: [], B: ["addr1"]}, None, None)
    step.last, step.by = Last(), {B: State({(1.0,): (40,)})}
    rows = [Row(TransactionID=i, TransactionDT=100 + i, addr1=1.0 + i % 2) for i in range(20)]
    got = list(step.handleInputRows((1,), iter(rows), clock))
    assert [r[B] for r in got] == [60.0, None] + [2.0] * 18 and [r[A] for r in got] == [50.0] + [1.0] * 19
    assert step.by[B].calls == 4 and dict(step.by[B]) == {(1.0,): (118,), (2.0,): (119,)} and step.last.value == (119, 19)


def test_slices_of_several_files_are_one_micro_batch_each(spark, monkeypatch):
    monkeypatch.setattr(queries, "_FILE_ROWS", 30)
    rows = frame(spark, *_rows(120)).withColumn("split", F.expr("if(TransactionID < 100, 'train', if(TransactionID < 102, 'val', 'holdout'))"))
    stream = queries.in_batches(spark, rows, ["train", "val", "holdout"])
    sink, state = (fresh_path(spark, n) for n in ("out", "state"))
    start_routing(stream, lambda batch: {"rows": batch}, sink, state).awaitTermination()
    got = read_routed(spark, sink, "rows")
    assert {r.batch: r["count"] for r in got.groupBy("batch").count().collect()} == {0: 100, 1: 2, 2: 18}
    assert got.select(F.input_file_name()).distinct().count() > 3


def test_large_tables_meet_a_stream_without_being_repeated(spark):
    rows = frame(spark, *_rows(200))
    fitted = fit_encodings(row_features(rows))
    source, sink, state = (fresh_path(spark, n) for n in ("in", "out", "state"))
    rows.write.parquet(source)
    encoded = lambda df: apply_encodings(row_features(df), fitted, broadcast_rows=0, hot_rows=20)
    stream = encoded(spark.readStream.schema(rows.schema).parquet(source))
    assert "explode(sequence(0, 15" not in stream._jdf.queryExecution().logical().toString()
    stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    assert sorted(map(str, spark.read.parquet(sink).collect())) == sorted(map(str, encoded(rows).collect()))
