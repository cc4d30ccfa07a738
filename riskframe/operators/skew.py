"""Hot keys: finding them, and joining a lookup table without gathering them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.session import materialise

# A key with more rows than this is split over several tasks.
HOT_ROWS = 4_000_000
# A lookup table up to this many rows is sent to every executor.
BROADCAST_ROWS = 1_000_000
# Sampled rows a hot key should show up with, and still be recognised below.
_EXPECTED, _ENOUGH = 400, 200
# Rows of a stream can't be counted beforehand: all are spread over this many salts.
STREAM_SALTS = 16


def hot_tables(df: DataFrame, key_sets: Sequence[Sequence[str]], hot_rows: int = HOT_ROWS) -> list[DataFrame]:
    """For each set of keys a written table (keys, ``_salts``): keys with more than about ``hot_rows`` rows, and the
    number of tasks each should be spread over.

    ``df`` is read once, for a sample in which such a key has hundreds of rows. Callers only use the tables to spread
    work, so a key near the limit may fall on either side. A table has at most BROADCAST_ROWS rows, as a key needs
    more than that part of the sample.
    """
    columns = list(dict.fromkeys(c for keys in key_sets for c in keys))
    fraction = min(1.0, _EXPECTED / hot_rows)
    narrow = df.select(*columns)
    sampled = materialise(narrow if fraction == 1.0 else narrow.sample(fraction, seed=26), "key-sample")
    least = max(hot_rows if fraction == 1.0 else _ENOUGH, sampled.count() // BROADCAST_ROWS)
    salts = F.greatest(F.lit(2), F.ceil(F.col("count") / (fraction * hot_rows))).cast("int")
    return [
        materialise(sampled.groupBy(*keys).count().where(F.col("count") > least).select(*keys, salts.alias("_salts")), "hot-keys")
        for keys in key_sets
    ]


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys that hold more than about ``hot_rows`` rows; see ``hot_tables``."""
    return hot_tables(df, [keys], hot_rows)[0].drop("_salts")


def known_hot(table: DataFrame, keys: Sequence[str], count: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The like of ``hot_tables`` for a stream, whose rows can't be sampled: keys that ``table`` itself has counted as hot."""
    salts = F.greatest(F.lit(2), F.ceil(F.col(count) / hot_rows)).cast("int")
    return table.where(F.col(count) > hot_rows).select(*keys, salts.alias("_salts"))


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    table_rows: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    spread_by: str = "TransactionID",
    hot: DataFrame | None = None,
) -> DataFrame:
    """``rows`` left-joined with ``table`` on null-safe keys.

    A table of at most ``broadcast_rows`` rows (counted, unless the caller knows
    the number) is broadcast and ``rows`` does not move.  A larger one is joined
    by shuffle; hot keys of ``rows`` (found here, unless the caller gives their
    table, as it must for a stream that is not to repeat the whole table) then get salts taken from ``spread_by``, as many as their rows ask for,
    and their table rows are repeated once per salt.
    """
    n = table.count() if table_rows is None else table_rows
    if n <= broadcast_rows:
        return _null_safe_left(rows, table, keys, broadcast=True)
    salt = F.xxhash64(spread_by)
    if rows.isStreaming and hot is None:
        salted = rows.withColumn("_salt", F.pmod(salt, F.lit(STREAM_SALTS)).cast("int"))
        repeated = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(STREAM_SALTS - 1))))
        return _null_safe_left(salted, repeated, [*keys, "_salt"]).drop("_salt")
    hot = hot_tables(rows, [keys], hot_rows)[0] if hot is None else hot
    flagged = _null_safe_left(rows, hot, keys, broadcast=True)
    salted = flagged.withColumn(
        "_salt", F.coalesce(F.pmod(salt, F.col("_salts")).cast("int"), F.lit(0))
    ).drop("_salts")
    repeated = _null_safe_left(table, hot, keys, broadcast=True).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    ).drop("_salts")
    return _null_safe_left(salted, repeated, [*keys, "_salt"]).drop("_salt")


def _null_safe_left(rows: DataFrame, right: DataFrame, keys: Sequence[str], broadcast: bool = False) -> DataFrame:
    """Left join in which a missing key matches a missing key."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    match = reduce(Column.__and__, [rows[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys])
    joined = rows.join(F.broadcast(renamed) if broadcast else renamed, match, "left")
    return joined.drop(*[f"_r_{k}" for k in keys])
