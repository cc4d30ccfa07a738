import random

import pytest
from pyspark.sql import functions as F

from riskframe.operators import positions
from riskframe.operators.positions import (
    Order, evenly_spaced, number_rows, order_statistics, order_statistics_of, pick_positions)


def frame(spark, rows, kind="bigint"):
    return spark.createDataFrame(rows, f"k {kind}, id bigint").repartition(3)


def expected(rows, descending):
    return sorted(rows, key=lambda r: (-r[0] if descending else r[0], r[1]))


@pytest.mark.parametrize("kind", ["bigint", "double"])
@pytest.mark.parametrize("descending", [False, True])
def test_every_position_with_a_third_of_rows_on_one_key(spark, kind, descending):
    rng = random.Random(1)
    rows = [(7 if i % 3 == 0 else rng.randrange(-50, 400), i * 1000 + 5) for i in range(600)]
    rows = [(float(k) / 8 if kind == "double" else k, i) for k, i in rows]
    n, at = order_statistics(
        frame(spark, rows, kind), "k", "id", lambda n: range(0, n, 37), descending, buckets=32, fetch_rows=20
    )
    want = expected(rows, descending)
    assert n == 600
    assert at == {p: want[p] for p in range(0, 600, 37)}


def test_many_positions_over_several_levels(spark):
    rng = random.Random(2)
    rows = [((9 if i % 3 == 0 else rng.randrange(0, 10_000)), i) for i in range(2000)]
    for kind in ("bigint", "double"):
        typed = [(float(k) if kind == "double" else k, i) for k, i in rows]
        _, at = order_statistics(
            frame(spark, typed, kind), "k", "id", lambda n: range(0, n, 20), True, buckets=256, fetch_rows=60
        )
        want = expected(typed, True)
        assert at == {p: want[p] for p in range(0, 2000, 20)}


def test_far_apart_keys_need_several_levels(spark):
    rows = [(10**15 if i == 0 else i % 5, i) for i in range(300)]
    _, at = order_statistics(frame(spark, rows), "k", "id", lambda n: [0, 150, n - 1], buckets=16, fetch_rows=5)
    want = expected(rows, False)
    assert at == {p: want[p] for p in (0, 150, 299)}


def test_repeated_rows_null_keys_and_bounds(spark):
    n, at = order_statistics(frame(spark, [(1, 1)] * 50 + [(None, 2)]), "k", "id", lambda n: [0, 49], buckets=16, fetch_rows=5)
    assert n == 50 and at == {0: (1, 1), 49: (1, 1)}
    with pytest.raises(ValueError):
        order_statistics(frame(spark, [(1, 1)]), "k", "id", lambda n: [1])
    assert order_statistics(frame(spark, [(None, 1)]), "k", "id", lambda n: range(n)) == (0, {})


def test_pick_and_spacing(spark):
    rows = [(i // 4, i) for i in range(40)]
    picked = pick_positions(frame(spark, rows), "k", "id", lambda n: evenly_spaced(n, 5)).orderBy("position_no").collect()
    assert [(r.position_no, r.id) for r in picked] == [(1, 0), (2, 9), (3, 19), (4, 29), (5, 39)]
    assert evenly_spaced(3, 5) == [0, 1, 2]


def test_number_rows(spark):
    rows = [(5 if i % 2 else i, i) for i in range(200)]
    out = number_rows(frame(spark, rows), ["k", "id"], "pos", partitions=7).collect()
    got = [(r.k, r.id) for r in sorted(out, key=lambda r: r.pos)]
    assert sorted(r.pos for r in out) == list(range(200))
    assert got == expected(rows, False)


@pytest.mark.parametrize("kind", ["bigint", "double"])
def test_several_orders_in_one_search(spark, kind, monkeypatch):
    rng = random.Random(4)
    value = lambda: None if rng.random() < 0.1 else (3 if rng.random() < 0.3 else rng.randrange(0, 900))
    rows = [(value(), value(), i) for i in range(700)]
    df = spark.createDataFrame(rows, "a long, b long, id long").repartition(3)
    df = df.withColumns({"a": df.a.cast(kind), "b": df.b.cast(kind), "none": (df.a * 0).cast("string").cast(kind)})
    df = df.withColumn("none", F.when(F.lit(False), df.none))
    every = lambda n: range(0, n, 31)
    orders = [
        Order("a", "id", every, True), Order("a", "id", every), Order("b", "id", lambda n: [n - 1]),
        Order("none", "id", every), Order("b", "id", lambda n: []),
    ]
    single = [order_statistics(df, o.key, o.tie, o.wanted, o.descending, 64, 10) for o in orders]
    searches = []
    search = positions._search
    monkeypatch.setattr(positions, "_search", lambda *args: searches.append(1) or search(*args))
    assert order_statistics_of(df, orders, buckets=64, fetch_rows=10) == single
    assert len(searches) == 1 and single[3] == (0, {}) and single[4][1] == {}
    for down, column, (n, at) in ((True, 0, single[0]), (False, 0, single[1]), (False, 1, single[2])):
        want = expected([(r[column], r[2]) for r in rows if r[column] is not None], down)
        assert n == len(want) and at == {p: want[p] for p in at}


def test_orders_of_both_kinds_are_exact(spark):
    far = 2**53
    df = spark.createDataFrame([(far + i, i / 4, i) for i in range(40)], "a long, b double, id long")
    whole, floating = order_statistics_of(
        df, [Order("a", "id", lambda n: [1, 38]), Order("b", "id", lambda n: [0, 39], True)], buckets=16, fetch_rows=4
    )
    assert whole == (40, {1: (far + 1, 1), 38: (far + 38, 38)})
    assert floating == (40, {0: (39 / 4, 39), 39: (0.0, 0)})
