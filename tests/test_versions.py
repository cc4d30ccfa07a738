"""Replaced tables: the old version stays until the new one is whole."""

import os

import pytest
from pyspark.sql import functions as F

from riskframe.operators import encode
from riskframe.plans.features import row_features
from riskframe.session import fresh_path
from riskframe.sources import tables, versions
from rows import frame, row


def _failing(spark):
    """A table whose last part fails while the first ones are written."""
    bad = F.when(F.col("id") == 999, F.raise_error(F.lit("executor lost"))).otherwise(F.col("id"))
    return spark.range(0, 1000, 1, 4).select(bad.cast("bigint").alias("id"))


def test_a_failed_job_leaves_the_old_table(spark):
    path = fresh_path(spark, "table")
    with pytest.raises(FileNotFoundError):
        versions.read_table(spark, path)
    tables.write_parquet(spark.range(5), path)
    with pytest.raises(Exception, match="executor lost"):
        tables.write_parquet(_failing(spark), path)
    assert tables.read_parquet(spark, path).count() == 5
    tables.write_parquet(tables.read_parquet(spark, path).where("id < 3"), path)  # reads what it replaces
    assert tables.read_parquet(spark, path).count() == 3


def test_a_reader_keeps_the_version_it_has_begun_with(spark):
    path = fresh_path(spark, "table")
    for n in (1, 2, 3, 4):
        before = versions.read_table(spark, path) if n > 1 else None
        versions.replace_table(spark.range(n), path)
        if before is not None:
            assert before.count() == n - 1
    folders = [f for f in os.listdir(path.removeprefix("file:")) if f.startswith("version-")]
    assert len(folders) == versions.KEPT and versions.read_table(spark, path).count() == 4


def test_maps_are_replaced_together(spark, monkeypatch):
    path = fresh_path(spark, "maps")
    encode.fit_encodings(row_features(frame(spark, row())), path)
    sums = encode._sums
    monkeypatch.setattr(encode, "_sums", lambda rows, keys: sums(rows, keys) if "start_day" in keys else _failing(spark))
    with pytest.raises(Exception, match="executor lost"):
        encode.fit_encodings(row_features(frame(spark, row(), row(TransactionID=2))), path)
    counts = encode.load_encodings(spark, path).counts
    assert [counts[c].first().cnt for c in ("uid_count", "P_emaildomain_count")] == [1, 1]


def test_plain_paths_and_patterns_are_read_as_they_are(spark):
    path = fresh_path(spark, "plain")
    spark.range(3).write.parquet(f"{path}/a")
    spark.range(4).write.parquet(f"{path}/b")
    assert tables.read_parquet(spark, f"{path}/a").count() == 3 and tables.read_parquet(spark, f"{path}/*").count() == 7
