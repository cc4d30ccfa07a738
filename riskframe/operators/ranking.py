"""Questions about the order of scores, answered from a few exact positions."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import exact_mean
from riskframe.operators.positions import (
    Order, Position, at_or_before, evenly_spaced, order_statistics, order_statistics_of, pick_positions)
from riskframe.schema import (
    CALIBRATION_BINS, CHECK_POSITIVES, CHECK_ROWS, EXAMPLE_ROWS, ID, LABEL, POLICY_FRACTION,
    REVIEW_FRACTIONS, TIME, VERIFICATION_ROWS,
)
from riskframe.session import together


def top_size(n: int, fraction: float) -> int:
    return max(1, round(n * fraction))


Found = tuple[int, dict[int, Position]]


def queue_order(score: str = "score", fractions: Sequence[float] = REVIEW_FRACTIONS) -> Order:
    """The last row of each queue size."""
    return Order(score, ID, lambda n: [top_size(n, f) - 1 for f in fractions] if n else [], descending=True)


def queue_counts(
    found: Found, score: str = "score", label: str = LABEL, fractions: Sequence[float] = REVIEW_FRACTIONS,
    prefix: str = "_",
) -> list[Column]:
    """Aggregates that ``queue_rows`` reads: positives, and those inside each queue."""
    n, at = found
    if not n:
        raise ValueError("no scored rows")
    positive = (F.col(label) == 1) & F.col(score).isNotNull()
    return [F.count(F.when(positive, 1)).alias(f"{prefix}positives")] + [
        F.count(F.when(positive & at_or_before(score, ID, at[top_size(n, f) - 1], descending=True), 1)).alias(f"{prefix}tp{i}")
        for i, f in enumerate(fractions)
    ]


def queue_rows(
    found: Found, fractions: Sequence[float] = REVIEW_FRACTIONS, digits: int = 4, prefix: str = "_"
) -> Column:
    """The queue table of one aggregated row, as an array of structs, one for each queue size."""
    positives = F.nullif(F.col(f"{prefix}positives"), F.lit(0))

    def entry(i: int, fraction: float) -> Column:
        size, caught = F.lit(top_size(found[0], fraction)).cast("long"), F.col(f"{prefix}tp{i}")
        return F.struct(
            F.lit(float(fraction)).alias("top_fraction"), size.alias("n_reviewed"), caught.alias("true_positives"),
            F.round(caught / size, digits).alias("precision"), F.round(caught / positives, digits).alias("recall"),
        )

    return F.array(*[entry(i, f) for i, f in enumerate(fractions)])


def review_queue(
    scored: DataFrame, score: str = "score", label: str = LABEL, fractions: Sequence[float] = REVIEW_FRACTIONS,
    digits: int = 4,
) -> DataFrame:
    """Precision and recall of the highest-scored rows, for each queue size; rows without a score count for nothing."""
    (found,) = order_statistics_of(scored, [queue_order(score, fractions)])
    counted = scored.agg(*queue_counts(found, score, label, fractions))
    return counted.select(F.inline(queue_rows(found, fractions, digits)))


def bin_edges(n: int, bins: int) -> list[int]:
    return np.linspace(0, n, bins + 1).astype(int).tolist()


def bin_order(score: str = "score", bins: int = CALIBRATION_BINS) -> Order:
    """The last row of each bin."""
    return Order(score, ID, lambda n: [edge - 1 for edge in bin_edges(n, bins)[1:] if edge > 0])


def calibration_table(
    scored: DataFrame, score: str = "score", label: str = LABEL, bins: int = CALIBRATION_BINS, found: Found | None = None
) -> DataFrame:
    """Mean score and observed rate in bins of consecutive score positions; ``found`` holds them if they are known."""
    n, at = found or order_statistics_of(scored, [bin_order(score, bins)])[0]
    edges = bin_edges(n, bins)
    number = F.lit(None).cast("int")
    for i in range(bins, 0, -1):
        if edges[i] > edges[i - 1]:
            number = F.when(at_or_before(score, ID, at[edges[i] - 1]), i).otherwise(number)
    return scored.where(F.col(score).isNotNull()).groupBy(number.alias("bin")).agg(
        F.count("*").alias("count"),
        exact_mean(F.col(score)).alias("mean_predicted"),
        exact_mean(F.col(label)).alias("observed_rate"),
    )


def score_examples(
    scored: DataFrame, score: str = "score", label: str = LABEL, amount: str = "amt_log", product: str = "ProductCD",
    rows: int = EXAMPLE_ROWS,
) -> DataFrame:
    """Rows evenly spaced over the descending scores, with their ids masked."""
    picked = pick_positions(scored, score, ID, lambda n: evenly_spaced(n, rows), descending=True)
    return picked.select(
        F.format_string("HOLDOUT-%02d", "position_no").alias("example_id"),
        F.round(F.col(amount).cast("double"), 3).alias("amount_log"),
        F.coalesce(F.col(product).cast("string"), F.lit("NA")).alias("product_code"),
        F.round(score, 6).alias("calibrated_score"),
        F.col(label).cast("int").alias("true_label"),
    )


def stratified_sample(
    rows: DataFrame, label: str = LABEL, n_rows: int = CHECK_ROWS, n_positive: int = CHECK_POSITIVES
) -> DataFrame:
    """A fixed set of rows, evenly spaced in time within each label."""
    def pick(value: int, k: int) -> DataFrame:
        return pick_positions(rows.where(F.col(label) == value), TIME, ID, lambda n: evenly_spaced(n, k))

    positive, negative = together(lambda: pick(1, n_positive), lambda: pick(0, n_rows - n_positive))
    return positive.unionByName(negative).drop("position_no")


def first_in_time(rows: DataFrame, n: int = VERIFICATION_ROWS) -> DataFrame:
    """Spark keeps only n rows per partition for this, so nothing is sorted whole."""
    return rows.orderBy(TIME, ID).limit(n)


def top_overlap(rows: DataFrame, first: str, second: str, fraction: float = POLICY_FRACTION) -> DataFrame:
    """Share of the top rows by one score that are top rows by the other too."""
    last = [Order(score, ID, lambda n: [top_size(n, fraction) - 1], descending=True) for score in (first, second)]
    (n, a), (_, b) = order_statistics_of(rows, last)
    k = top_size(n, fraction)
    in_both = at_or_before(first, ID, a[k - 1], descending=True) & at_or_before(second, ID, b[k - 1], descending=True)
    return rows.agg(F.count(F.when(in_both, 1)).alias("n_both")).select(
        F.lit(k).cast("long").alias("k"), "n_both", (F.col("n_both") / F.lit(float(k))).alias("overlap")
    )


def interpolated_percentile(rows: DataFrame, column: str, share: float, tie: str = ID) -> tuple[int, float | None]:
    """``(n, value)``: the percentile between two neighbouring order statistics."""
    spot = lambda n: (n - 1) * share
    n, at = order_statistics(
        rows, column, tie, lambda n: {math.floor(spot(n)), math.ceil(spot(n))} if n else []
    )
    if not n:
        return 0, None
    low, high = at[math.floor(spot(n))][0], at[math.ceil(spot(n))][0]
    return n, float(low + (high - low) * (spot(n) - math.floor(spot(n))))


def nearest_rank(rows: DataFrame, column: str, shares: Sequence[float], tie: str = ID) -> dict[float, int]:
    """Percentiles that are values of the data, at floor(n * share); 0 if there are none."""
    spot = lambda n, share: min(math.floor(n * share), n - 1)
    n, at = order_statistics(rows, column, tie, lambda n: {spot(n, s) for s in shares} if n else [])
    return {s: round(at[spot(n, s)][0]) if n else 0 for s in shares}


def fit_review_policy(
    validation: DataFrame, score: str = "score", fraction: float = POLICY_FRACTION
) -> dict:
    """The score that the given share of validation rows reaches.

    The cutoff is rounded to 6 digits, which on a plateau may round it past the
    very scores it was fitted on; the exact value is kept beside it.
    """
    n, cutoff = interpolated_percentile(validation, score, 1 - fraction)
    if cutoff is None:
        raise ValueError("no scored validation rows to fit a cutoff on")
    return {
        "top_fraction": fraction,
        "fitted_cutoff": round(cutoff, 6),
        "exact_cutoff": cutoff,
        "fitted_on": "validation",
        "n_validation": n,
    }
