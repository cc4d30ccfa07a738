import math

import pytest
from pyspark.sql import functions as F
from rows import by_id, frame, row

from riskframe.functions import columns as C
from riskframe.plans import features as feat
from riskframe.schema import column_family, identity_schema, numeric_family_columns, transaction_schema


def built(spark, *rows):
    return by_id(feat.build_features(frame(spark, *rows)))


def test_row_features(spark):
    got = built(spark, row(), row(TransactionID=2, M1="F", TransactionAmt=-5.0), row(TransactionID=3, M1=None, TransactionAmt=None))
    assert (got[1].day_index, got[1].hour_of_day) == (1, 1.0)
    assert got[1].amt_log == pytest.approx(math.log(100), rel=1e-6)
    assert [got[i].M1 for i in (1, 2, 3)] == [1.0, 0.0, None]
    assert got[2].amt_log == 0.0 and got[3].amt_log is None
    assert (got[1].card1, got[1].addr1, got[1].uid) == ("1001", "200.0", "1001||200.0||-1.0")


def test_account_parts(spark):
    changes = [{}, {"D1": 5.0}, {"addr1": 7.0}, {"card1": 7}, {"D1": None}, {"D1": None, "card1": 7}]
    got = built(spark, *[row(TransactionID=i, **c) for i, c in enumerate(changes)])
    assert len({r.uid for r in got.values()}) == len(changes)


def test_start_day_rounds_half_even_without_negative_zero(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.5), (0, 0.4)], "day int, d double")
    out = [r.s for r in df.select(C.key_text(C.start_day(F.col("day"), F.col("d"))).alias("s")).collect()]
    assert out == ["0.0", "2.0", "0.0"]


def test_lenient_numbers(spark):
    texts = ["12", " 12 ", "abc", "NaN", "", None, "1e3", "12d", "7F", "-3.5"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.v for r in df.select(C.lenient_double(F.col("t")).alias("v")).collect()]
    assert got == [12.0, 12.0, None, None, None, None, 1000.0, None, None, -3.5]


def test_label_is_never_read(spark):
    rows = [row(TransactionID=i, card1=i % 3, isFraud=i % 2, TransactionDT=i * 50) for i in range(20)]
    df = frame(spark, *rows)
    base = feat.build_features(df)
    for other in (df.drop("isFraud"), df.withColumn("isFraud", 1 - F.col("isFraud"))):
        changed = feat.build_features(other)
        assert base.exceptAll(changed).isEmpty() and changed.exceptAll(base).isEmpty()
    assert "isFraud" not in base.columns


def test_absent_columns(spark):
    df = frame(spark, row()).drop("addr1", "D1", "P_emaildomain", "V1")
    got = by_id(feat.build_features(df))[1]
    assert got.uid == "1001||nan||nan" and got.addr1_count == 1.0
    aligned = feat.align(df, {"V1": "float", "C1": "float"}, ["TransactionID"]).first()
    assert tuple(aligned) == (1, None, 1.0)


def test_wide_frames_take_key_features_by_id(spark, monkeypatch):
    rows = [row(TransactionID=i, TransactionDT=i * 10 % 70, card1=i % 4, addr1=None if i % 3 else 1.0) for i in range(40)]
    df = frame(spark, *rows)
    plain = feat.build_features(df)
    monkeypatch.setattr(feat, "WIDE_COLUMNS", 1)
    for options in ({}, {"broadcast_rows": 0, "hot_rows": 5}):
        wide = feat.build_features(df, unique_ids=True, **options)
        assert wide.count() == 40 and wide.select(plain.columns).exceptAll(plain).isEmpty()


def test_validation(spark):
    df = spark.createDataFrame(
        [("1", "5", "3.0"), (None, "5", "3.0"), ("2", "x", None)], "TransactionID string, TransactionDT string, TransactionAmt string")
    good, bad = feat.split_valid(df)
    assert [(r.TransactionID, r.TransactionDT) for r in good.collect()] == [(1, 5)]
    reasons = [r.reasons for r in bad.collect()]
    assert reasons == [["missing TransactionID"], ["invalid TransactionDT", "missing TransactionAmt"]]
    assert feat.default_id(df.drop("TransactionID")).first().TransactionID == 0
    assert feat.validate(df.drop("TransactionDT")).where("array_contains(reasons, 'missing TransactionDT')").count() == 3


def test_strict_long_fails_on_null(spark):
    with pytest.raises(Exception, match="required value is null"):
        frame(spark, row()).select(C.strict_long(F.lit(None).cast("string"))).collect()


def test_mask(spark):
    df = feat.build_features(frame(spark, row(TransactionID=1), row(TransactionID=2, TransactionDT=99999)))
    masked = feat.mask_history(df)
    assert masked.where("time_since_prev_card1 is not null").count() == 0
    rest = [c for c in df.columns if not c.startswith("time_since")]
    assert masked.select(rest).exceptAll(df.select(rest)).isEmpty()


def test_schemas_and_families():
    assert len(transaction_schema().fields) == 394 and len(transaction_schema(False).fields) == 393
    assert len(identity_schema().fields) == 41
    sizes = {}
    for f in [*transaction_schema().fields, *identity_schema().fields[1:]]:
        sizes[column_family(f.name)] = sizes.get(column_family(f.name), 0) + 1
    assert sizes == {"card": 6, "addr": 2, "dist": 2, "email": 2, "C": 14, "D": 15, "M": 9, "V": 339, "identity": 38,
                     "device": 2, "other": 5}
    assert numeric_family_columns(["V1", "Vx", "C2", "D", "D3", "card1", "V10"]) == ["V1", "V10", "C2", "D3"]
