"""Exact time-ordered split into training, validation and holdout rows."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.positions import Position, at_or_before, order_statistics
from riskframe.schema import HOLDOUT_FRACTION, ID, LABEL, TIME, VALIDATION_FRACTION


@dataclass(frozen=True)
class TimeSplit:
    """Fitted cut points; assigning a row to a slice needs nothing else."""

    n_total: int
    n_train: int
    n_val: int
    n_holdout: int
    train_end: Position | None
    pool_end: Position | None

    def assign(self, df: DataFrame, alias: str = "split") -> DataFrame:
        return df.withColumn(
            alias,
            F.when(at_or_before(TIME, ID, self.train_end), "train")
            .when(at_or_before(TIME, ID, self.pool_end), "val")
            .otherwise("holdout"),
        )

    def to_dict(self) -> dict:
        return asdict(self)

    @classmethod
    def from_dict(cls, values: dict) -> TimeSplit:
        ends = {k: tuple(values[k]) if values[k] else None for k in ("train_end", "pool_end")}
        return cls(**{**values, **ends})


def split_sizes(n: int, holdout_frac: float, val_frac: float) -> tuple[int, int, int]:
    """Sizes round half to even, as Python's ``round`` does."""
    n_holdout = round(n * holdout_frac)
    n_pool = n - n_holdout
    n_val = round(n_pool * val_frac)
    return n_pool - n_val, n_val, n_holdout


def fit_time_split(
    df: DataFrame, holdout_frac: float = HOLDOUT_FRACTION, val_frac: float = VALIDATION_FRACTION, **limits: int
) -> TimeSplit:
    """Find the last training row and the last pool row in (time, id) order."""
    def last_rows(n: int) -> tuple[int, int]:
        n_train, n_val, _ = split_sizes(n, holdout_frac, val_frac)
        return n_train - 1, n_train + n_val - 1

    n, at = order_statistics(df, TIME, ID, lambda n: [p for p in last_rows(n) if p >= 0], **limits)
    train_last, pool_last = last_rows(n)
    return TimeSplit(n, *split_sizes(n, holdout_frac, val_frac), at.get(train_last), at.get(pool_last))


def split_summary(rows: DataFrame, label: str = LABEL) -> DataFrame:
    """Per slice: rows, positives, rate and time span.  ``rows`` carries ``split``."""
    positives = F.sum(F.col(label).cast("long"))
    return rows.groupBy("split").agg(
        F.count("*").alias("n_rows"),
        positives.alias("n_positive"),
        F.round(positives / F.count("*"), 6).alias("positive_rate"),
        F.min(TIME).alias("first_time"),
        F.max(TIME).alias("last_time"),
    )


def split_record(split: TimeSplit, rows: DataFrame, label: str = LABEL) -> DataFrame:
    """The split as one record: sizes, cutoffs, rates and the positive weight."""
    def rate(name: str):
        return F.avg(F.when(F.col("split") == name, F.col(label).cast("double")))

    in_train = F.col("split") == "train"
    positive = F.sum(F.when(in_train, F.col(label)).otherwise(0)).cast("long")
    negative = F.count(F.when(in_train, F.lit(1))) - positive
    cutoff = lambda end: F.lit(end[0] if end else None).cast("long")
    return rows.agg(
        F.lit(split.n_total).cast("long").alias("n_total"),
        F.lit(split.n_train).cast("long").alias("n_train"),
        F.lit(split.n_val).cast("long").alias("n_val"),
        F.lit(split.n_holdout).cast("long").alias("n_holdout"),
        cutoff(split.pool_end).alias("holdout_cutoff_dt"),
        cutoff(split.train_end).alias("val_cutoff_dt"),
        rate("train").alias("train_positive_rate"),
        rate("val").alias("val_positive_rate"),
        (negative / F.greatest(positive, F.lit(1))).alias("positive_weight"),
    )


def positive_weight(rows: DataFrame, label: str = LABEL) -> DataFrame:
    """Class balance of the given (training) rows: negatives per positive."""
    positive = F.sum(F.col(label).cast("long"))
    return rows.agg(
        positive.alias("n_positive"),
        (F.count("*") - positive).alias("n_negative"),
        ((F.count("*") - positive) / F.greatest(positive, F.lit(1))).alias("positive_weight"),
    )
