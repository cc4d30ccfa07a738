"""Quality of scores against labels."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.columns import exact_mean
from riskframe.operators.positions import order_statistics_of
from riskframe.operators.ranking import bin_order, calibration_table, queue_counts, queue_order, queue_rows
from riskframe.schema import LABEL
from riskframe.session import materialise, together

# Distinct scores one task runs over; longer score columns get more ranges.
RANGE_ROWS = 4_000_000
# Ranges whose edges are listed on the driver; where more are needed, a range exchange makes them.
FEWEST_RANGES, MOST_RANGES = 128, 16_384


def _range_edges(rows: DataFrame, range_rows: int, most_ranges: int) -> list[float] | None:
    """Scores that cut the rows of each order into ranges of at most about ``range_rows`` rows,
    apart from rows that share one score; none if that takes more than ``most_ranges``."""
    def cut(ranges: int):
        shares = ", ".join(f"{i / ranges!r}D" for i in range(1, ranges))
        sketch = F.expr(f"percentile_approx(_score, array({shares}), {max(10_000, 5 * ranges)})")
        return rows.groupBy("_order").agg(F.count("*").alias("n"), sketch.alias("cuts")).collect()

    found = cut(FEWEST_RANGES)
    needed = max((row.n for row in found), default=0) // range_rows + 1
    if needed > most_ranges:
        return None
    if needed > FEWEST_RANGES:
        found = cut(needed)
    return sorted({score for row in found for score in row.cuts}) or [0.0]


def _per_score(rows: DataFrame, range_rows: int, most_ranges: int) -> DataFrame:
    """(_order, _range, _score, pos, cnt): sums by distinct score, and the range of scores each lies in."""
    sums = [F.sum("_y").alias("pos"), F.count("*").alias("cnt")]
    edges = _range_edges(rows, range_rows, most_ranges)
    if edges is None:
        summed = materialise(rows.groupBy("_order", "_score").agg(*sums), "scores")
        ranges = summed.count() // range_rows + 1
        dealt = summed.repartitionByRange(ranges, "_order", "_score").withColumn("_range", F.spark_partition_id())
        return materialise(dealt, "score-ranges")
    splits = [float("-inf"), *edges, float("inf")]
    ranged = Bucketizer(splits=splits, inputCol="_score", outputCol="_range").transform(rows)
    return ranged.withColumn("_range", F.col("_range").cast("int")).groupBy("_order", "_range", "_score").agg(*sums)


def ranking_areas(
    scored: DataFrame, score: str = "score", label: str = LABEL, range_rows: int = RANGE_ROWS,
    most_ranges: int = MOST_RANGES,
) -> DataFrame:
    """ROC-AUC (ties count half) and average precision, as one row.

    Both areas are null where a class is missing.
    """
    return ranking_areas_of(scored, {"area": score}, label, range_rows, most_ranges).select("area.*")


def ranking_areas_of(
    scored: DataFrame, scores: dict[str, str], label: str = LABEL, range_rows: int = RANGE_ROWS,
    most_ranges: int = MOST_RANGES,
) -> DataFrame:
    """The areas of several scores of the same rows, as one row with a struct for each name in ``scores``.

    Rows are first summed per score column and distinct score.  Running sums then
    go over score ranges: within a range by a window, across ranges by a table
    with one row per range.  All columns share the passes of one.
    """
    entries = F.array(*[
        F.struct(F.lit(i).alias("_order"), F.col(score).cast("double").alias("_score"), F.col(label).cast("long").alias("_y"))
        for i, score in enumerate(scores.values())
    ])
    rows = scored.select(F.inline(entries)).where(F.col("_score").isNotNull())
    per_score = _per_score(rows, range_rows, most_ranges)

    everything = Window.partitionBy("_order")
    above = everything.orderBy(F.desc("_range"))
    per_range = per_score.groupBy("_order", "_range").agg(F.sum("pos").alias("p"), F.sum("cnt").alias("c"))
    starts = per_range.select(
        "_order", "_range",
        (F.sum("p").over(above) - F.col("p")).alias("p_above"),
        (F.sum("c").over(above) - F.col("c")).alias("c_above"),
        F.sum("p").over(everything).alias("P"),
        F.sum("c").over(everything).alias("N"),
    )
    down = Window.partitionBy("_order", "_range").orderBy(F.desc("_score"))
    sums = (
        per_score.withColumns({"p_run": F.sum("pos").over(down), "c_run": F.sum("cnt").over(down)})
        .join(F.broadcast(starts), ["_order", "_range"])
        .withColumns({"tp": F.col("p_above") + F.col("p_run"), "reached": F.col("c_above") + F.col("c_run")})
    )
    negatives = F.col("N") - F.col("P")
    neg_here = F.col("cnt") - F.col("pos")
    neg_below = negatives - (F.col("reached") - F.col("tp"))
    won = F.col("pos").cast("double") * (neg_below.cast("double") + neg_here.cast("double") / 2)
    step = F.col("pos").cast("double") * F.col("tp") / F.col("reached")
    here = lambda i, value: F.when(F.col("_order") == i, value)
    total = sums.agg(*[
        part.alias(f"{name}{i}") for i in range(len(scores)) for name, part in (
            ("n", F.max(here(i, F.col("N")))), ("P", F.max(here(i, F.col("P")))),
            ("won", F.sum(here(i, won))), ("steps", F.sum(here(i, step))),
        )
    ])

    def areas(i: int) -> Column:
        n, positive = F.col(f"n{i}"), F.col(f"P{i}")
        both = (positive > 0) & (positive < n)
        return F.struct(
            F.coalesce(n, F.lit(0)).alias("n"),
            F.coalesce(positive, F.lit(0)).alias("n_positive"),
            F.when(both, F.col(f"won{i}") / (positive.cast("double") * (n - positive))).alias("roc_auc"),
            F.when(both, F.col(f"steps{i}") / positive).alias("average_precision"),
        )

    return total.select(*[areas(i).alias(name) for i, name in enumerate(scores)])


def brier_score(scored: DataFrame, score: str = "score", label: str = LABEL) -> DataFrame:
    """Mean squared difference of scores and labels, to 6 digits."""
    return scored.agg(_brier(score, label))


def _brier(score: str, label: str) -> Column:
    miss = F.col(score) - F.col(label)
    return exact_mean(miss * miss).alias("brier_score")


def _policy_counts(policy: dict, score: str, label: str) -> list[Column]:
    flagged, positive = F.col(score) >= F.lit(policy["fitted_cutoff"]), F.col(label) == 1
    return [
        F.count("*").alias("n"),
        F.count(F.when(flagged, 1)).alias("n_reviewed"),
        F.count(F.when(flagged & positive, 1)).alias("true_positives"),
        F.count(F.when(positive, 1)).alias("n_positive"),
    ]


def _policy_fields(policy: dict, digits: int = 4) -> list[Column]:
    def share(part: str, of: str) -> Column:
        return F.round(F.col(part) / F.nullif(F.col(of), F.lit(0)), digits)

    return [
        F.lit(policy["top_fraction"]).alias("top_fraction"),
        F.lit(policy["fitted_cutoff"]).alias("fitted_cutoff"),
        F.lit(policy["fitted_on"]).alias("fitted_on"),
        F.lit(policy["n_validation"]).cast("long").alias("n_validation"),
        share("n_reviewed", "n").alias("review_rate"),
        F.col("n_reviewed"),
        F.col("true_positives"),
        share("true_positives", "n_reviewed").alias("precision"),
        share("true_positives", "n_positive").alias("recall"),
    ]


def review_policy_metrics(
    scored: DataFrame, policy: dict, score: str = "score", label: str = LABEL, digits: int = 4
) -> DataFrame:
    """What the fitted cutoff does on other rows; undefined shares are null."""
    return scored.agg(*_policy_counts(policy, score, label)).select(*_policy_fields(policy, digits))


def rows_as_array(df: DataFrame, order: str, alias: str) -> DataFrame:
    """A short report table as one array of structs, ordered by its first field."""
    others = [c for c in df.columns if c != order]
    return df.agg(F.sort_array(F.collect_list(F.struct(order, *others))).alias(alias))


def cross(frames: list[DataFrame]) -> DataFrame:
    """One-row frames side by side; each is an aggregate without keys or a choice of one row."""
    return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), frames)


def evaluate(
    scored: DataFrame, policy: dict, importance: DataFrame | None = None, score: str = "score", label: str = LABEL
) -> DataFrame:
    """The whole evaluation record of scored rows, as one row.

    One search finds the positions of queue and bins; one aggregate gives all sums over the rows.
    """
    areas, (queue, bins) = together(
        lambda: ranking_areas(scored, score, label),
        lambda: order_statistics_of(scored, [queue_order(score), bin_order(score)]),
    )
    counted = scored.agg(
        F.count("*").alias("holdout_n"),
        F.sum(F.col(label).cast("long")).alias("holdout_positive_count"),
        exact_mean(F.col(label)).alias("holdout_positive_rate"),
        _brier(score, label),
        *_policy_counts(policy, score, label),
        *queue_counts(queue, score, label, prefix="queue_"),
    ).select(
        "holdout_n", "holdout_positive_count", "holdout_positive_rate", "brier_score",
        F.sort_array(queue_rows(queue, prefix="queue_")).alias("review_queue"),
        F.struct(*_policy_fields(policy)).alias("review_policy"),
    )
    parts = [
        counted,
        areas.select("roc_auc", F.col("average_precision").alias("pr_auc")),
        rows_as_array(calibration_table(scored, score, label, found=bins), "bin", "calibration_table"),
    ]
    if importance is not None:
        parts.append(rows_as_array(importance, "rank", "top_feature_importance"))
    return cross(parts)
