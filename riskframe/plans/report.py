"""Reports: one document from the one-row records and short tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.metrics import cross, rows_as_array

METRIC_FIELDS = ["roc_auc", "pr_auc", "brier_score", "holdout_n", "holdout_positive_count", "holdout_positive_rate"]
TABLE_FIELDS = ["review_queue", "review_policy", "calibration_table", "top_feature_importance"]


def as_struct(df: DataFrame, alias: str) -> DataFrame:
    return df.select(F.struct(*df.columns).alias(alias))


def assemble(
    facts: DataFrame, split: DataFrame, evaluation: DataFrame, examples: DataFrame, model: str = "riskframe"
) -> DataFrame:
    """The published document: facts, split, metrics, tables and example rows."""
    tables = [c for c in TABLE_FIELDS if c in evaluation.columns]
    metrics = evaluation.select(F.struct(*METRIC_FIELDS).alias("metrics"), *tables)
    return cross([
        as_struct(facts, "dataset_facts"),
        as_struct(split, "split"),
        metrics,
        rows_as_array(examples, "example_id", "example_rows"),
    ]).select(F.lit(model).alias("model"), "*")


def table_facts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row and column counts of the given tables as one record."""
    return cross([
        df.agg(F.count("*").alias(f"{name}_rows")).withColumn(f"{name}_columns", F.lit(len(df.columns)))
        for name, df in tables.items()
    ])


def as_fields(document: DataFrame) -> DataFrame:
    """A nested one-row document as (path, value) rows, values as JSON text."""
    entries = []

    def walk(column, kind, path):
        if kind.typeName() == "struct":
            for f in kind.fields:
                walk(column[f.name], f.dataType, f"{path}.{f.name}" if path else f.name)
        elif kind.typeName() == "array":
            entries.append((path, F.to_json(column, {"ignoreNullFields": "false"})))
        else:
            entries.append((path, column.cast("string")))

    for f in document.schema.fields:
        walk(F.col(f"`{f.name}`"), f.dataType, f.name)
    pairs = F.array(*[F.struct(F.lit(p).alias("path"), v.alias("value")) for p, v in entries])
    return document.select(F.explode(pairs).alias("e")).select("e.*")
