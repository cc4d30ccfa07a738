import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from rows import frame, row

from riskframe.operators import joins, quality
from riskframe.plans import report
from riskframe.schema import identity_schema, transaction_schema
from riskframe.session import fresh_path, materialise, shared_folder
from riskframe.sources import tables


def test_csv_round_trip_names_and_missing(spark):
    path = fresh_path(spark, "csv")
    identity = spark.createDataFrame([(1, -5.0, None, "x"), (2, float("nan"), "mobile", None)], "TransactionID bigint, `id-01` double, DeviceType string, `id-12` string")
    tables.write_csv(identity, path)
    back = tables.read_csv(spark, path, identity_schema())
    assert back.columns == ["TransactionID", "id_01", "DeviceType", "id_12"]
    assert sorted(back.collect()) == [(1, -5.0, None, "x"), (2, None, "mobile", None)]
    pruned = tables.read_csv(spark, path, identity_schema(), ["TransactionID"])
    assert "ReadSchema: struct<TransactionID:string>" in pruned._jdf.queryExecution().toString()


def test_unlabelled_file_reads_with_the_same_schema(spark):
    path = fresh_path(spark, "csv")
    tables.write_csv(frame(spark, row()).drop("isFraud"), path)
    assert "isFraud" not in tables.read_csv(spark, path, transaction_schema()).columns


def test_files_with_other_orders_and_bad_cells(spark):
    path = fresh_path(spark, "csv")
    tables.write_csv(spark.createDataFrame([("7", "1.5", "x200")], "TransactionID string, C1 string, TransactionDT string"), f"{path}/a")
    tables.write_csv(spark.createDataFrame([("5", "2.5", "8", "y")], "TransactionDT string, `id-01` string, TransactionID string, extra string"), f"{path}/b")
    rows = {r.TransactionID: r for r in tables.read_csv(spark, f"{path}/*", transaction_schema(), bad_cells="bad").collect()}
    assert (rows[7].C1, rows[7].TransactionDT, rows[7].bad) == (1.5, None, ["TransactionDT"])
    assert (rows[8].C1, rows[8].TransactionDT, rows[8].id_01, rows[8].extra, rows[8].bad) == (None, 5, "2.5", "y", [])


LINES = ['TransactionID,C1,ProductCD', '1,2.5,W', '2,3', '3,1,W,more', '4,"1,W', '5,1,"W', '', '6,x,"a, ""b"""', '7,,', 'TransactionID,C1,ProductCD']


def _csv(spark, lines, name="part.csv"):
    path = fresh_path(spark, "csv")
    table = spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1)
    table.write.text(f"{path}/a", compression="gzip" if name.endswith("gz") else "none")
    return f"{path}/a"


@pytest.mark.parametrize("name", ["part.csv", "part.csv.gz"])
def test_malformed_lines_are_kept_as_they_are(spark, name):
    path = _csv(spark, LINES, name)
    rows = tables.read_csv(spark, path, transaction_schema(), bad_cells="bad", malformed="line").collect()
    assert sorted(r.line for r in rows if r.line) == sorted(['2,3', '3,1,W,more', '4,"1,W', '5,1,"W'])
    assert all((r.TransactionID, r.C1, r.ProductCD, r.bad) == (None, None, None, []) for r in rows if r.line)
    good = {r.TransactionID: (r.C1, r.ProductCD, r.bad) for r in rows if not r.line}
    assert good == {1: (2.5, "W", []), 6: (None, 'a, "b"', ["C1"]), 7: (None, None, [])}
    pruned = tables.read_csv(spark, path, transaction_schema(), ["ProductCD"], malformed="line")
    assert pruned.columns == ["ProductCD", "line"] and pruned.where("line is null").count() == 3


def test_a_whole_scan_fails_on_a_malformed_line(spark):
    for line in ("2,3", "3,1,W,more"):
        with pytest.raises(Exception, match=f"malformed line: {line}"):
            tables.read_csv(spark, _csv(spark, [LINES[0], LINES[1], line]), transaction_schema()).collect()
    empty = _csv(spark, [])
    with pytest.raises(ValueError, match="no CSV file"):
        tables.read_csv(spark, empty, transaction_schema())


def test_quotes_survive_a_round_trip(spark):
    path = fresh_path(spark, "csv")
    texts = ['say "hi"', '"', "a,b", 'back\\slash"', "plain"]
    tables.write_csv(spark.createDataFrame(list(enumerate(texts)), "TransactionID long, ProductCD string"), path)
    for option in ({}, {"malformed": "line"}):
        back = tables.read_csv(spark, path, transaction_schema(), **option)
        assert [r.ProductCD for r in back.orderBy("TransactionID").collect()] == texts


def test_nested_numbers_are_strict_json(spark):
    nan, inf = float("nan"), float("inf")
    schema = "a array<double>, s struct<x: float, t: struct<y: array<struct<z: double>>>, n: string>, m map<string, array<double>>, k int"
    df = spark.createDataFrame([
        ([nan, 1.0, None], (inf, ([(nan,), (2.0,)],), "NaN"), {"p": [-inf, 3.0]}, 1), (None, None, None, None), ([], (None, None, None), {}, 2)], schema)
    got = [json.loads(r.input, parse_constant=lambda c: pytest.fail(c)) for r in df.select(tables.strict_json(df, df.columns)).collect()]
    assert got[0] == {"a": [None, 1.0, None], "s": {"x": None, "t": {"y": [{"z": None}, {"z": 2.0}]}, "n": "NaN"}, "m": {"p": [None, 3.0]}, "k": 1}
    assert got[1] == {"a": None, "s": None, "m": None, "k": None}
    assert got[2] == {"a": [], "s": {"x": None, "t": None, "n": None}, "m": {}, "k": 2}


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        get = staticmethod(lambda name, default=None: default)

    class Session:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "spark://host:7077", "applicationId": "a"})()

    with pytest.raises(RuntimeError):
        shared_folder(Session())


def test_report_keeps_nulls_and_json_is_strict(spark):
    path = fresh_path(spark, "report")
    tables.write_report(spark.createDataFrame([(1, None)], "a int, b double"), path)
    assert json.loads(spark.read.text(path).first()[0]) == {"a": 1, "b": None}
    df = spark.createDataFrame([(1, float("nan")), (2, float("inf")), (3, float("-inf")), (4, 1.5)], "i int, v double")
    texts = [r.input for r in df.select(tables.strict_json(df, ["i", "v"])).collect()]
    parsed = [json.loads(t, parse_constant=lambda c: pytest.fail(c)) for t in texts]
    assert [p["v"] for p in parsed] == [None, None, None, 1.5]


def test_ledger_keeps_all_and_finds_the_latest(spark):
    path = fresh_path(spark, "ledger")
    for ts in ("2024-01-02", "2024-01-03", "2024-01-01"):
        tables.append_run(spark.createDataFrame([(ts, 1)], "ts string, n int"), path)
    ledger = spark.read.parquet(path)
    assert ledger.count() == 3 and tables.latest_run(ledger).first().ts == "2024-01-03"


def test_shared_folder_is_the_sessions_own(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert not named or shared_folder(spark) == named.rstrip("/")
    df = materialise(spark.range(5).withColumn("p", F.col("id") % 2), "t", ["p"])
    assert df.count() == 5 and df.where("p = 0").count() == 3


def test_identity_join(spark):
    tx = frame(spark, *[row(TransactionID=i) for i in (1, 2, 3)])
    idn = spark.createDataFrame([(2, "mobile")], "TransactionID bigint, DeviceType string")
    joined = joins.join_identity(tx, idn, unique_identity=True)
    assert joined.count() == 3 and joined.where("DeviceType IS NULL").count() == 2
    twice = idn.union(idn)
    assert joins.join_identity(tx, twice).count() == 4
    with pytest.raises(ValueError):
        joins.join_identity(tx, twice, unique_identity=True)
    covered = quality.identity_coverage(tx, twice).first()
    assert (covered.n_with_identity, covered.pct_with_identity) == (1, 33.333)


def test_quality(spark):
    tx = frame(spark, row(), row(TransactionID=2, addr1=None, isFraud=1))
    profile = quality.profile_tables({"a": tx, "b": tx.drop("isFraud")}, {"a": 2, "b": 5}).collect()
    assert [(r.n_rows, r.has_label, r.mismatch) for r in profile] == [(2, True, False), (2, False, True)]
    assert quality.marker_rows(tx).first().n_with_marker is None
    rates = {r.family: r for r in quality.missing_rates_by_family(tx).collect()}
    assert rates["addr"].mean_missing_rate == 0.5 and rates["M"].n_columns == 2
    checks = quality.selection_checks(tx.union(tx), 4, 2).first()
    assert (checks.size_ok, checks.positives_ok, checks.ids_ok, checks.passes) == (True, True, False, False)


def test_interpolation_equals_numpy(spark):
    xs, ys = [0.0, 0.2, 0.25, 0.9], [0.1, 0.1, 0.4, 0.95]
    curve = spark.createDataFrame(list(zip(xs, ys)), "x double, y double")
    values = [-1.0, 0.0, 0.1, 0.2, 0.21, 0.25, 0.5, 0.9, 2.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    for most in (joins.CURVE_POINTS, 2):
        got = {r.v: r.y for r in joins.interpolate(df, curve, "v", "y", most).collect()}
        assert [got[v] for v in values] == pytest.approx(np.interp(values, xs, ys).tolist(), abs=1e-15)
        assert got[None] is None and len(got) == len(values) + 1


def test_document_fields(spark):
    doc = spark.createDataFrame([(1, [(2, "x")], (3.5,))], "a int, t array<struct<n:int,s:string>>, m struct<v:double>")
    got = {r.path: r.value for r in report.as_fields(doc).collect()}
    assert got == {"a": "1", "t": '[{"n":2,"s":"x"}]', "m.v": "3.5"}
