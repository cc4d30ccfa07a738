"""Joins of whole tables: identity onto transactions, calibration, comparison."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.positions import number_rows
from riskframe.schema import ID
from riskframe.session import materialise


def duplicate_keys(df: DataFrame, key: str = ID) -> DataFrame:
    return df.groupBy(key).count().where(F.col("count") > 1)


def join_identity(transactions: DataFrame, identity: DataFrame, unique_identity: bool = False) -> DataFrame:
    """Every transaction, with its identity columns where there are any.

    A repeated identity key repeats the transaction, unless ``unique_identity``
    asks for that to be an error.
    """
    if unique_identity and not duplicate_keys(identity).isEmpty():
        raise ValueError(f"identity table repeats {ID}")
    return transactions.join(identity, ID, "left")


# Points of a curve up to which it is read on the driver; a longer one is cut into stretches and joined.
CURVE_POINTS, CURVE_STRETCHES = 100_000, 4096


def interpolate(
    df: DataFrame, thresholds: DataFrame, column: str, alias: str, curve_points: int = CURVE_POINTS
) -> DataFrame:
    """Map ``column`` through the piecewise-linear curve of (x, y) thresholds.

    Values outside the curve are clipped to its ends.  The points are counted first.  A curve of up to ``curve_points``
    is read on the driver: rows find their segment by binary search and meet its end points in a broadcast equi-join.
    The segments of a longer one are joined by the stretch of the curve they lie in.
    """
    points = thresholds.select(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).distinct()
    n = points.count()
    if not n:
        raise ValueError("no thresholds")
    if n > curve_points:
        return _interpolate_long(df, points, column, alias)
    found = sorted((r.x, r.y) for r in points.collect())
    xs = [x for x, _ in found]
    if len(found) == 1:
        return df.withColumn(alias, F.when(F.col(column).isNotNull(), F.lit(found[0][1])))
    segments = [(float(i), x0, y0, x1, y1) for i, ((x0, y0), (x1, y1)) in enumerate(zip(found, found[1:]))]
    curve = df.sparkSession.createDataFrame(segments, "_s double, _x0 double, _y0 double, _x1 double, _y1 double")
    inside = F.when(F.col(column) < xs[0], xs[0]).when(F.col(column) > xs[-1], xs[-1]).otherwise(F.col(column))
    searched = Bucketizer(
        splits=[float("-inf"), *xs[1:-1], float("inf")], inputCol="_x", outputCol="_s", handleInvalid="keep"
    ).transform(df.withColumn("_x", inside.cast("double")))
    return _along(searched.join(F.broadcast(curve), "_s", "left"), alias).drop("_s")


def _along(joined: DataFrame, alias: str) -> DataFrame:
    line = F.col("_y0") + (F.col("_x") - F.col("_x0")) * (F.col("_y1") - F.col("_y0")) / (F.col("_x1") - F.col("_x0"))
    return joined.withColumn(alias, line).drop("_x", "_x0", "_y0", "_x1", "_y1")


def _interpolate_long(df: DataFrame, points: DataFrame, column: str, alias: str) -> DataFrame:
    """The same with the curve as a table: its segments, repeated for each stretch they reach into."""
    numbered = materialise(number_rows(points, ["x", "y"], "_n"), "curve")
    after = numbered.select((F.col("_n") - 1).alias("_n"), F.col("x").alias("_x1"), F.col("y").alias("_y1"))
    shares = ", ".join(f"{i / CURVE_STRETCHES!r}D" for i in range(1, CURVE_STRETCHES))
    ends = numbered.agg(F.min("x").alias("low"), F.max("x").alias("high"),
                        F.expr(f"percentile_approx(x, array({shares}), 50000)").alias("cuts")).first()
    splits = [float("-inf"), *sorted({c for c in ends.cuts if ends.low < c < ends.high}), float("inf")]
    stretch = lambda rows, x, name: Bucketizer(
        splits=splits, inputCol=x, outputCol=name, handleInvalid="keep").transform(rows)
    segments = numbered.select("_n", F.col("x").alias("_x0"), F.col("y").alias("_y0")).join(after, "_n").drop("_n")
    segments = stretch(stretch(segments.where("_x0 < _x1"), "_x0", "_from"), "_x1", "_to")
    segments = segments.withColumn("_s", F.explode(F.sequence(F.col("_from").cast("int"), F.col("_to").cast("int")))).drop("_from", "_to")
    inside = F.greatest(F.least(F.col(column).cast("double"), F.lit(ends.high)), F.lit(ends.low))
    rows = df.withColumn("_x", F.when(F.col(column).isNotNull(), inside))
    rows = stretch(rows, "_x", "_at").withColumn("_s", F.col("_at").cast("int")).drop("_at")
    last = F.lit(ends.high)
    here = (F.col("_x") >= F.col("_x0")) & ((F.col("_x") < F.col("_x1")) | ((F.col("_x") == last) & (F.col("_x1") == last)))
    match = (rows["_s"] == segments["_s"]) & here
    return _along(rows.join(segments, match, "left").drop("_s"), alias)


def curve_steps(points: DataFrame) -> DataFrame:
    """The points (x, y) of a curve with their distance dx, dy from the point before (null for the first).

    Each joins its predecessor by number, so that no task orders them all.
    """
    numbered = materialise(number_rows(points, ["x", "y"], "_n"), "curve")
    before = numbered.select((F.col("_n") + 1).alias("_n"), F.col("x").alias("_x0"), F.col("y").alias("_y0"))
    steps = numbered.join(before, "_n", "left")
    return steps.select("x", "y", (F.col("x") - F.col("_x0")).alias("dx"), (F.col("y") - F.col("_y0")).alias("dy"))


def compare_scores(left: DataFrame, right: DataFrame, score: str = "score", flag: str = "review_flag") -> DataFrame:
    """Both tables' score and flag side by side per id, with what differs.

    A full outer join: rows missing on one side are differences too.
    """
    a = left.select(ID, F.col(score).alias("left_score"), F.col(flag).alias("left_flag"), F.lit(True).alias("in_left"))
    b = right.select(ID, F.col(score).alias("right_score"), F.col(flag).alias("right_flag"), F.lit(True).alias("in_right"))
    both = a.join(b, ID, "full").fillna(False, ["in_left", "in_right"])
    paired = F.col("in_left") & F.col("in_right")
    return both.withColumns({
        "abs_diff": F.when(paired, F.abs(F.col("left_score") - F.col("right_score"))),
        "flag_differs": F.when(paired, ~F.col("left_flag").eqNullSafe(F.col("right_flag"))),
    })


def is_mismatch():
    one_side = ~(F.col("in_left") & F.col("in_right"))
    half_null = F.col("left_score").isNull() != F.col("right_score").isNull()
    return one_side | half_null | F.coalesce(F.col("abs_diff") != 0, F.lit(False)) | F.coalesce("flag_differs", F.lit(False))


def comparison_summary(compared: DataFrame) -> DataFrame:
    count_if = lambda c: F.count(F.when(c, F.lit(1)))
    return compared.agg(
        F.count("*").alias("n_ids"),
        count_if(~F.col("in_right")).alias("n_only_left"),
        count_if(~F.col("in_left")).alias("n_only_right"),
        F.max("abs_diff").alias("max_abs_diff"),
        count_if(F.col("flag_differs")).alias("n_flag_mismatches"),
        count_if(is_mismatch()).alias("n_mismatches"),
    )
