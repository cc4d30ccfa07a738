"""Checks of the input tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.schema import ID, LABEL, TIME, column_family


def profile_tables(tables: Mapping[str, DataFrame], expected: Mapping[str, int]) -> DataFrame:
    """Per table: rows, columns, whether it has a label, and rows expected."""
    parts = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"),
            "n_rows",
            F.lit(len(df.columns)).alias("n_columns"),
            F.lit(LABEL in df.columns).alias("has_label"),
            F.lit(expected.get(name)).cast("long").alias("expected_rows"),
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("mismatch", F.coalesce(F.col("n_rows") != F.col("expected_rows"), F.lit(False)))


def label_profile(df: DataFrame, label: str = LABEL) -> DataFrame:
    positive = F.sum(F.col(label).cast("long"))
    return df.agg(
        F.count("*").alias("n_rows"),
        positive.alias("n_positive"),
        F.round(positive / F.count("*"), 6).alias("positive_rate"),
        F.min(TIME).alias("first_time"),
        F.max(TIME).alias("last_time"),
    )


def identity_coverage(transactions: DataFrame, identity: DataFrame) -> DataFrame:
    """Transactions with at least one identity row; repeated rows count once."""
    has = identity.select(ID).distinct().withColumn("_has", F.lit(1))
    joined = transactions.select(ID).join(has, ID, "left")
    covered = F.count("_has")
    return joined.agg(
        F.count("*").alias("n_rows"),
        covered.alias("n_with_identity"),
        F.round(100 * covered / F.count("*"), 3).alias("pct_with_identity"),
    )


def marker_rows(df: DataFrame, marker: str = "id_01") -> DataFrame:
    """Rows in which the marker column has a value; null if there is no such column."""
    rows = F.count(marker) if marker in df.columns else F.lit(None).cast("long")
    return df.agg(F.count("*").alias("n_rows"), rows.alias("n_with_marker"))


def missing_rates(df: DataFrame) -> DataFrame:
    """Per column: its family and the share of rows without a value; one pass."""
    counted = df.agg(F.count("*").alias("_n"), *[F.count(c).alias(c) for c in df.columns])
    entries = [
        F.struct(F.lit(column_family(c)).alias("family"), F.lit(c).alias("column"), F.col(c).alias("present"))
        for c in df.columns
    ]
    rows = counted.select("_n", F.explode(F.array(*entries)).alias("e")).select("_n", "e.*")
    return rows.select(
        "family", "column", ((F.col("_n") - F.col("present")) / F.nullif(F.col("_n"), F.lit(0))).alias("missing_rate")
    )


def missing_rates_by_family(df: DataFrame) -> DataFrame:
    rate = F.col("missing_rate")
    return missing_rates(df).groupBy("family").agg(
        F.count("*").alias("n_columns"),
        F.round(F.avg(rate), 4).alias("mean_missing_rate"),
        F.round(F.min(rate), 4).alias("min_missing_rate"),
        F.round(F.max(rate), 4).alias("max_missing_rate"),
    )


def selection_checks(df: DataFrame, n_rows: int, positive_floor: int, label: str = LABEL) -> DataFrame:
    """A chosen set of rows must have a size, enough positives and no id twice."""
    out = df.agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.sum(F.col(label).cast("long")), F.lit(0)).alias("n_positive"),
        F.countDistinct(ID).alias("n_ids"),
    )
    return out.withColumns({
        "size_ok": F.col("n_rows") == n_rows,
        "positives_ok": F.col("n_positive") >= positive_floor,
        "ids_ok": F.col("n_ids") == F.col("n_rows"),
    }).withColumn("passes", F.col("size_ok") & F.col("positives_ok") & F.col("ids_ok"))
