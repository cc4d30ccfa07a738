import math
import re

import pytest
from pyspark.sql import functions as F
from rows import by_id, frame, row

from riskframe.operators import encode
from riskframe.operators.skew import hot_keys, lookup_join
from riskframe.plans.features import build_features, row_features


def fit(spark, *rows):
    return encode.fit_encodings(row_features(frame(spark, *rows)))


def test_fit_counts_and_apply_are_separate(spark):
    fitted = fit(spark, row(TransactionID=1), row(TransactionID=2), row(TransactionID=3, card1=2002))
    counts = {r.card1: r.cnt for r in fitted.counts["card1_count"].collect()}
    assert counts == {1001: 2, 2002: 1}
    got = by_id(build_features(frame(spark, row(TransactionID=99)), fitted))
    assert got[99].card1_count == 2.0


def test_unseen_keys(spark):
    fitted = fit(spark, row())
    unseen = row(TransactionID=5, card1=9, addr1=9.0, P_emaildomain="x", D1=None)
    got = by_id(build_features(frame(spark, unseen), fitted))[5]
    assert (got.card1_count, got.addr1_count, got.P_emaildomain_count, got.uid_count) == (0.0, 0.0, 0.0, 0.0)
    assert (got.card1_addr1_count, got.card1_P_emaildomain_count) == (0.0, 0.0)
    assert got.card1_mean_amt is None and got.card1_addr1_mean_amt is None and got.amt_to_card1_mean_ratio is None
    assert got.uid.endswith("||nan")


def test_missing_is_a_key_of_its_own(spark):
    fitted = fit(spark, row(TransactionID=1, P_emaildomain=None), row(TransactionID=2, P_emaildomain=None),
                 row(TransactionID=3, P_emaildomain="nan"), row(TransactionID=4, addr1=None))
    rows = frame(spark, row(TransactionID=1, P_emaildomain=None), row(TransactionID=2, P_emaildomain="nan"),
                 row(TransactionID=3, addr1=None))
    got = by_id(build_features(rows, fitted))
    assert [got[i].P_emaildomain_count for i in (1, 2)] == [2.0, 1.0]
    assert got[3].card1_addr1_count == 1.0 and got[1].card1_P_emaildomain_count == 2.0


def test_missing_amounts_count_but_do_not_average(spark):
    fitted = fit(spark, row(TransactionID=1, TransactionAmt=None), row(TransactionID=2), row(TransactionID=3, TransactionAmt=0.0))
    got = by_id(build_features(frame(spark, row(TransactionID=2)), fitted))[2]
    assert got.card1_addr1_count == 3.0
    assert got.card1_mean_amt == pytest.approx(math.log(100) / 2, rel=1e-6)
    assert got.amt_to_card1_mean_ratio == pytest.approx(2.0, rel=1e-6)


def test_zero_mean_gives_no_ratio(spark):
    fitted = fit(spark, row(TransactionAmt=0.0))
    assert by_id(build_features(frame(spark, row()), fitted))[1].amt_to_card1_mean_ratio is None


def test_composite_counts(spark):
    fitted = fit(spark, row(TransactionID=1), row(TransactionID=2), row(TransactionID=3, addr1=1.0), row(TransactionID=4, card1=5))
    counts = sorted(r.cnt for r in fitted.groups["card1_addr1"].collect())
    assert counts == [1, 1, 2]


def test_shuffled_and_salted_joins_equal_the_broadcast(spark):
    rows = [row(TransactionID=i, card1=None if i % 3 == 0 else 1 if i % 3 == 1 else i, addr1=float(i % 4) if i % 4 else None)
            for i in range(300)]
    df = row_features(frame(spark, *rows)).repartition(4)
    fitted = encode.fit_encodings(df.where("TransactionID < 200"))
    wide = encode.apply_encodings(df, fitted)
    salted = encode.apply_encodings(df, fitted, broadcast_rows=0, hot_rows=20)
    assert salted.count() == 300
    assert wide.exceptAll(salted).isEmpty() and salted.exceptAll(wide).isEmpty()
    coarse = encode.load_encodings(spark, _written(df), broadcast_rows=0)
    assert encode.apply_encodings(df, coarse).exceptAll(encode.apply_encodings(df, encode.fit_encodings(df))).isEmpty()


def _written(df):
    from riskframe.session import fresh_path

    path = fresh_path(df.sparkSession, "maps")
    encode.fit_encodings(df, path)
    return path


def test_hot_keys_names_the_missing_key(spark):
    df = spark.createDataFrame([(None if i % 2 else i,) for i in range(100)], "k bigint")
    assert [r.k for r in hot_keys(df, ["k"], 30).collect()] == [None]
    table = spark.createDataFrame([(None, "m"), (4, "f")], "k bigint, v string")
    out = lookup_join(df.withColumn("TransactionID", F.lit(1)), table, ["k"], broadcast_rows=0, hot_rows=30)
    assert out.where("v = 'm'").count() == 50 and out.where("v = 'f'").count() == 1 and out.count() == 100


def test_dictionary_codes_follow_text_order(spark):
    df = frame(spark, row(TransactionID=1, card1=9), row(TransactionID=2, card1=10), row(TransactionID=3, ProductCD=None, card1=200))
    codes = encode.fit_dictionary(df, ["card1", "ProductCD"])
    got = {(r.column, r.value): r.code for r in codes.collect()}
    assert got == {("card1", "10"): 0, ("card1", "200"): 1, ("card1", "9"): 2, ("ProductCD", "W"): 0}
    applied = by_id(encode.apply_dictionary(df, codes, "ProductCD", "code"))
    assert [applied[i].code for i in (1, 3)] == [0, None]


def _coded(spark, n=300):
    names = [f"t{i}" for i in range(130)]
    values = lambda i: [None if (i + k) % 11 == 0 else f"v{i % (k % 7 + 2)}" for k in range(130)]
    df = spark.createDataFrame([(i, float(i), *values(i)) for i in range(n)], "id bigint, x double, " + ", ".join(f"{c} string" for c in names))
    vocabulary = encode.fit_dictionary(df.where("id < 200"), names[:6], counts=True)
    from riskframe.session import materialise

    return df, materialise(vocabulary, "vocabulary"), names[:6]


def test_large_vocabularies_are_looked_up_beside_wide_rows(spark):
    df, vocabulary, names = _coded(spark)
    sizes = dict.fromkeys(names, 10) | {"t3": 2_000_000, "t5": 3_000_000}
    plain = encode.apply_vocabulary(df, vocabulary, dict.fromkeys(names, 10))
    for unique_id in ("id", None):
        wide = encode.apply_vocabulary(df, vocabulary, sizes, hot_rows=50, unique_id=unique_id)
        assert wide.count() == 300 and wide.select(plain.columns).exceptAll(plain).isEmpty()


def test_no_shuffle_carries_the_wide_row_twice(spark):
    df, vocabulary, names = _coded(spark)
    sizes = dict.fromkeys(names, 2_000_000)
    out = encode.apply_vocabulary(df, vocabulary, sizes, unique_id="id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    carried = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line and "t129" in " ".join(lines[i:i + 2])]
    assert len(carried) <= 1 and len(re.findall(r"Exchange hashpartitioning\(id", plan)) == 2
    again = out.join(df.select("id", "x").withColumnRenamed("x", "y"), "id")  # rows lie by id already
    assert len(re.findall(r"Exchange hashpartitioning\(id", again._jdf.queryExecution().executedPlan().toString())) <= 3


def test_some_maps_find_hot_keys_once(spark, monkeypatch):
    base = row_features(frame(spark, *[row(TransactionID=i, card1=7 if i % 3 else i, addr1=float(i % 4)) for i in range(60)]))
    fitted, searches, find = encode.fit_encodings(base), [], encode.hot_tables
    monkeypatch.setattr(encode, "hot_tables", lambda df, keys, n: searches.append(len(keys)) or find(df, keys, n))
    whole = by_id(encode.apply_encodings(base, fitted))
    for maps in (list(encode.FREQUENCY_KEYS), list(encode.GROUP_KEYS), ["addr1_count"]):
        some = encode.apply_encodings(base, fitted, broadcast_rows=0, hot_rows=5, maps=maps)
        added = [c for c in some.columns if c not in base.columns]
        assert added and all(getattr(r, c) == getattr(whole[i], c) for i, r in by_id(some).items() for c in added)
        assert ("amt_to_card1_mean_ratio" in added) == ("card1" in maps)
    assert searches == [4, 3, 1]


def _exchanges(df):
    """The exchanges by key in the plan, each with the line of the columns that it moves; small tables are not broadcast unasked."""
    conf, name = df.sparkSession.conf, "spark.sql.autoBroadcastJoinThreshold"
    before = conf.get(name)
    conf.set(name, "-1")
    try:
        df = df.select("*")
        df._jdf.queryExecution().executedPlan()
    finally:
        conf.set(name, before)
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return [" ".join(lines[i:i + 2]) for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]


def test_one_large_vocabulary_moves_the_rows_once(spark):
    df, vocabulary, names = _coded(spark)
    narrow = df.select("id", "x", *names[:3])
    plain = encode.apply_vocabulary(narrow, vocabulary, dict.fromkeys(names[:3], 10))
    out = encode.apply_vocabulary(narrow, vocabulary, dict.fromkeys(names[:2], 10) | {names[2]: 2_000_000}, hot_rows=50, unique_id="id")
    moved = _exchanges(out)
    assert len(moved) == 2 and not any("hashpartitioning(id" in e for e in moved)  # the rows by value, and the vocabulary
    assert not any(f"{c}_{kind}" in e for e in moved for c in names[:2] for kind in ("code", "seen"))
    assert out.count() == 300 and out.select(plain.columns).exceptAll(plain).isEmpty()


def test_maps_that_move_rows_go_before_those_that_do_not(spark):
    base = row_features(frame(spark, *[row(TransactionID=i, card1=i % 7, addr1=float(i % 4)) for i in range(60)]))
    fitted = encode.fit_encodings(base)
    plain = encode.apply_encodings(base, fitted)
    fitted.n_rows["card1_addr1"] = 2_000_000
    out = encode.apply_encodings(base, fitted)
    rows_move = [e for e in _exchanges(out) if "amt_log" in e]
    assert rows_move and not any(c in e for e in rows_move for c in ("_count", "_mean_amt"))
    assert out.columns == plain.columns and out.exceptAll(plain).isEmpty() and plain.exceptAll(out).isEmpty()
