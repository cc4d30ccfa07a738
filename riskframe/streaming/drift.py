"""Drift records of a growing response log, one for each window of event time.

The stream keeps counts, not rows: for each window how many responses had which score, and how many of them were positive,
and how many took which time. Counts of parts add up, and areas and percentiles follow from them exactly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskframe.schema import DRIFT_TOLERANCE, LABEL, TIME
from riskframe.streaming.route import start_routing

SCORE_KIND, ELAPSED_KIND = "score", "elapsed"
WINDOW = ["window_from", "window_to"]


def response_counts(
    responses: DataFrame, seconds: int, lateness: int = 0, score: str = "calibrated_probability", elapsed: str = "elapsed_ms",
    label: str = LABEL, time: str = TIME, digits: int = 6,
) -> DataFrame:
    """(window_from, window_to, kind, value, n, n_positive) of windows of ``seconds``, each once it is closed.

    A window is closed when the watermark, ``lateness`` seconds behind the latest time, has passed its end; responses that
    come later are dropped, as their record is out. Scores count by ``digits`` digits, which is how the service answers, and
    times by whole milliseconds: a window keeps at most as many counts as there are such values. A missing score is an error
    and counts under no value.
    """
    clocked = responses.withColumn("_clock", F.timestamp_seconds(time)).withWatermark("_clock", f"{lateness} seconds")
    entry = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.cast("double").alias("value"))
    both = F.array(entry(SCORE_KIND, F.round(score, digits)), entry(ELAPSED_KIND, F.round(elapsed)))
    melted = clocked.select("_clock", F.col(label).cast("long").alias("_y"), F.explode(both).alias("e"))
    counted = melted.groupBy(F.window("_clock", f"{seconds} seconds").alias("w"), F.col("e.kind").alias("kind"), F.col("e.value").alias("value")).agg(
        F.count("*").alias("n"), F.coalesce(F.sum("_y"), F.lit(0)).alias("n_positive"))
    edge = lambda name: F.unix_timestamp(F.col(f"w.{name}")).alias
    return counted.select(edge("start")("window_from"), edge("end")("window_to"), "kind", "value", "n", "n_positive")


def start_counting(counts: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append the counts of closed windows to table ``counts`` of ``route``."""
    return start_routing(counts, lambda batch: {"counts": batch}, path, checkpoint, **trigger)


def _below(rows: DataFrame) -> DataFrame:
    """With ``reached``, the rows of the window up to this value, and ``n_below``, the negatives below it."""
    order = Window.partitionBy(*WINDOW).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    negative = F.col("n") - F.col("n_positive")
    return rows.withColumns({"reached": F.sum("n").over(order), "n_below": F.sum(negative).over(order) - negative})


def window_records(counts: DataFrame, recorded: float, tolerance: float = DRIFT_TOLERANCE, shares: tuple = (0.50, 0.95)) -> DataFrame:
    """One record for each window: n, errors, recorded, observed, tolerance, match, p50_ms, p95_ms, duration_s.

    The area is taken over answered rows, where both classes occur; any error makes the record not match.
    """
    answered = _below(counts.where((F.col("kind") == SCORE_KIND) & F.col("value").isNotNull()))
    positives, rows = F.sum("n_positive"), F.sum("n")
    won = F.sum(F.col("n_positive") * (F.col("n_below").cast("double") + (F.col("n") - F.col("n_positive")) / 2))
    pairs = positives.cast("double") * (rows - positives)
    areas = answered.groupBy(*WINDOW).agg(F.when(pairs > 0, F.round(won / pairs, 6)).alias("observed"))

    sizes = counts.groupBy(*WINDOW).agg(*[F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias(name) for name, c in {
        "n": F.col("kind") == SCORE_KIND, "errors": (F.col("kind") == SCORE_KIND) & F.col("value").isNull(),
        "timed": (F.col("kind") == ELAPSED_KIND) & F.col("value").isNotNull()}.items()])
    timed = _below(counts.where((F.col("kind") == ELAPSED_KIND) & F.col("value").isNotNull())).join(sizes.select(*WINDOW, "timed"), WINDOW)
    place = lambda share: F.least(F.floor(F.col("timed") * share), F.col("timed") - 1)
    ranks = timed.groupBy(*WINDOW).agg(
        *[F.min(F.when(F.col("reached") > place(s), F.col("value"))).cast("long").alias(f"p{round(100 * s)}_ms") for s in shares],
        F.round(F.sum(F.col("value") * F.col("n")) / 1000, 1).alias("duration_s"))

    joined = reduce(lambda a, b: a.join(b, WINDOW, "left"), [areas, ranks], sizes.drop("timed"))
    within: Column = F.coalesce(F.abs(F.col("observed") - recorded) <= tolerance, F.lit(False))
    zero = lambda s: F.coalesce(f"p{round(100 * s)}_ms", F.lit(0)).alias(f"p{round(100 * s)}_ms")
    return joined.select(
        *WINDOW, "n", F.lit(float(recorded)).alias("recorded"), "observed", F.lit(float(tolerance)).alias("tolerance"),
        ((F.col("errors") == 0) & within).alias("match"), *[zero(s) for s in shares], "errors", "duration_s")
