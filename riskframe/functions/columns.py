"""Column expressions of the feature set. All of them stay inside codegen."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskframe.schema import KEY_SEPARATOR, MISSING_TEXT, SECONDS_PER_DAY, SECONDS_PER_HOUR


def hour_of_day(seconds: Column) -> Column:
    return F.floor(F.pmod(seconds, F.lit(SECONDS_PER_DAY)) / SECONDS_PER_HOUR).cast("float")


def day_index(seconds: Column) -> Column:
    whole_days = seconds - F.pmod(seconds, F.lit(SECONDS_PER_DAY))
    return (whole_days / SECONDS_PER_DAY).cast("int")


def strict_long(value: Column) -> Column:
    """Ids and times: a value that does not fit is an error, never a null."""
    return F.when(value.isNull(), F.raise_error(F.lit("required value is null"))).otherwise(value.cast("long"))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def finite_or_null(value: Column) -> Column:
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def lenient_double(value: Column) -> Column:
    """Text that is no number, and NaN, become null.

    The JVM also reads ``12d`` and ``12f`` as numbers; here they are not.
    """
    text = F.trim(value.cast("string"))
    return nan_to_null(F.when(~text.rlike("(?i)[0-9.][df]$"), text.try_cast("double")))


def clip_at_zero(value: Column) -> Column:
    """Negative becomes zero; missing stays missing (``greatest`` would fill it)."""
    return F.when(value < 0, F.lit(0.0)).otherwise(value)


def log_amount(amount: Column) -> Column:
    return F.log1p(clip_at_zero(amount)).cast("float")


def flag_to_float(flag: Column) -> Column:
    return F.when(flag == "T", 1.0).when(flag == "F", 0.0).cast("float")


def start_day(day: Column, days_since_first: Column) -> Column:
    """The day an account began; half-even, and -0.0 folded into 0.0."""
    return F.rint(day.cast("double") - days_since_first.cast("double")) + F.lit(0.0)


def key_text(*parts: Column) -> Column:
    """Text form of a typed key, for exports only: joins never use it."""
    return F.concat_ws(KEY_SEPARATOR, *[F.coalesce(p.cast("string"), F.lit(MISSING_TEXT)) for p in parts])


def ratio_to_mean(amount: Column, mean: Column) -> Column:
    return (amount.cast("double") / F.nullif(mean.cast("double"), F.lit(0.0))).cast("float")


def review_flag(score: Column, threshold: float) -> Column:
    return score >= F.lit(float(threshold))


def report_round(value: Column, digits: int) -> Column:
    """Figures in reports: half up at this many digits."""
    return F.round(value, digits)


def exact_mean(value: Column, digits: int = 6) -> Column:
    """Mean of non-negative values, rounded half up.

    Values are summed as whole multiples of 1e-12, so the order of the rows does not matter.
    """
    unit, scale = Decimal(10 ** 12), Decimal(10 ** digits)
    total = F.sum(F.round(value.cast("double") * float(unit)).cast("decimal(28,0)"))
    n = F.count(value).cast("decimal(20,0)")
    above, below = total * F.lit(2 * scale) + n * F.lit(unit), n * F.lit(2 * unit)
    return ((above - above % below) / F.nullif(below, F.lit(Decimal(0)))).cast("double") / float(scale)
