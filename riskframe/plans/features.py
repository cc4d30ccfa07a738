"""The feature frame: one definition for batch and stream."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions import columns as C
from riskframe.operators.encode import WIDE_COLUMNS, Encodings, apply_encodings, fit_encodings
from riskframe.operators.joins import duplicate_keys
from riskframe.operators.history import time_since_previous
from riskframe.operators.skew import BROADCAST_ROWS, HOT_ROWS
from riskframe.schema import (
    AMOUNT, CATEGORICAL_COLUMNS, FLAG_COLUMNS, HISTORY_KEYS, ID, LABEL, NUMERIC_IDENTITY_COLUMNS, REQUIRED_FIELDS,
    TIME, numeric_family_columns,
)


def _or_null(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind).alias(name)


def _number(df: DataFrame, name: str) -> Column:
    """The column as double: text is parsed leniently, numbers only lose NaN."""
    if name not in df.columns:
        return F.lit(None).cast("double")
    if isinstance(df.schema[name].dataType, T.NumericType):
        return C.nan_to_null(F.col(name).cast("double"))
    return C.lenient_double(F.col(name))


def as_float(df: DataFrame, name: str) -> Column:
    """A number as the model stores it."""
    return _number(df, name).cast("float")


def without_label(df: DataFrame) -> DataFrame:
    return df.drop(LABEL)


def row_features(df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Features of a row alone, keys still typed.

    No feature reads the label.  ``carry`` names columns (the label, the slice)
    that pass through beside the features.
    """
    present = without_label(df).columns
    day = C.day_index(F.col(TIME))
    keys = {"card1": "bigint", "addr1": "double", "P_emaildomain": "string"}
    others = [c for c in CATEGORICAL_COLUMNS if c in present and c not in keys]
    return df.select(
        C.strict_long(F.col(ID)).alias(ID),
        C.strict_long(F.col(TIME)).alias(TIME),
        C.hour_of_day(F.col(TIME)).alias("hour_of_day"),
        day.alias("day_index"),
        C.log_amount(_number(df, AMOUNT)).alias("amt_log"),
        *[as_float(df, c).alias(c) for c in numeric_family_columns(present)],
        *[C.flag_to_float(F.col(c)).alias(c) for c in FLAG_COLUMNS if c in present],
        *[_or_null(df, c, kind) for c, kind in keys.items()],
        *[F.col(c).cast("string").alias(c) for c in others],
        *[as_float(df, c).alias(c) for c in NUMERIC_IDENTITY_COLUMNS if c in present],
        C.start_day(day, _number(df, "D1")).alias("start_day"),
        *carry,
    )


def _beside(rows: DataFrame, keys: Sequence[str], step: Callable[[DataFrame], DataFrame], unique_ids: bool) -> DataFrame:
    """Add the columns of ``step``, which reads the id and ``keys`` only.

    A wide frame whose ids are known to be unique is neither sorted nor shuffled
    by key: the step runs on its few key columns and is joined back by id.
    """
    if not unique_ids or len(rows.columns) <= WIDE_COLUMNS:
        return step(rows)
    narrow = step(rows.select(ID, *keys))
    return rows.join(narrow.drop(*keys).hint("shuffle_hash"), ID, "left")


def with_history(
    rows: DataFrame, unique_ids: bool = False, hot_rows: int = HOT_ROWS, n_rows: int | None = None
) -> DataFrame:
    """Add the times since the previous transaction."""
    keys = [TIME, "card1", "addr1"]
    return _beside(rows, keys, lambda r: time_since_previous(r, HISTORY_KEYS, hot_rows, n_rows), unique_ids)


def with_encodings(
    rows: DataFrame, fitted: Encodings, unique_ids: bool = False, broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add the fitted counts and means; rows only move for maps too big to broadcast."""
    keys = ["amt_log", "card1", "addr1", "P_emaildomain", "start_day"]
    moves = max(fitted.n_rows.values()) > broadcast_rows
    return _beside(rows, keys, lambda r: apply_encodings(r, fitted, broadcast_rows, hot_rows), unique_ids and moves)


def without_history(rows: DataFrame) -> DataFrame:
    """The two history features as null, as for a transaction scored alone."""
    return rows.withColumns({c: F.lit(None).cast("float") for c in HISTORY_KEYS})


def finish(rows: DataFrame) -> DataFrame:
    """Categories and the account as text, in the place of their typed keys."""
    account = C.key_text(F.col("card1"), F.col("addr1"), F.col("start_day")).alias("uid")
    text = [c for c in CATEGORICAL_COLUMNS if c in rows.columns]
    return rows.select(*[
        account if c == "start_day" else F.col(c).cast("string").alias(c) if c in text else F.col(c)
        for c in rows.columns
    ])


def build_features(
    df: DataFrame,
    fitted: Encodings | None = None,
    history: bool = True,
    unique_ids: bool = False,
    carry: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """All features.  Without ``fitted`` the encodings are fitted on ``df`` itself,
    which is only right for exploring that very frame."""
    rows = row_features(df, carry)
    rows = with_history(rows, unique_ids, hot_rows) if history else without_history(rows)
    fitted = fitted or fit_encodings(row_features(df))
    return finish(with_encodings(rows, fitted, unique_ids, broadcast_rows, hot_rows))


def require_unique(rows: DataFrame) -> None:
    """Joining back by id repeats rows whose ids repeat; who promises unique ids is held to it."""
    if not duplicate_keys(rows).isEmpty():
        raise ValueError(f"{ID} repeats")


def feature_columns(features: DataFrame) -> list[str]:
    return [c for c in features.columns if c not in (ID, TIME, LABEL, "split")]


def align(df: DataFrame, trained: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """The trained columns in trained order; absent ones as nulls of their type."""
    present = set(df.columns)
    return df.select(*keep, *[
        (F.col(c) if c in present else F.lit(None)).cast(kind).alias(c) for c, kind in trained.items()
    ])


def validate(df: DataFrame, required: Sequence[str] = REQUIRED_FIELDS) -> DataFrame:
    """Add ``reasons``: what keeps a row from being scored; empty for a good row.

    Ids and times must be whole numbers; the amount only has to be there.
    """
    def problem(name: str) -> Column:
        if name not in df.columns:
            return F.lit(f"missing {name}")
        bad = F.col(name).try_cast("bigint").isNull() if name in (ID, TIME) else F.lit(False)
        return F.when(F.col(name).isNull(), f"missing {name}").when(bad, f"invalid {name}")

    return df.withColumn("reasons", F.array_compact(F.array(*[problem(c) for c in required])))


def default_id(df: DataFrame) -> DataFrame:
    """Rows scored alone need no id; a table without ids gets 0."""
    return df if ID in df.columns else df.withColumn(ID, F.lit(0).cast("bigint"))


def split_valid(df: DataFrame, required: Sequence[str] = REQUIRED_FIELDS) -> tuple[DataFrame, DataFrame]:
    checked = validate(df, required)
    good = checked.where(F.size("reasons") == 0).drop("reasons")
    casts = {c: F.col(c).cast("bigint") for c in (ID, TIME) if c in good.columns}
    return good.withColumns(casts), checked.where(F.size("reasons") > 0)


def mask_history(features: DataFrame, columns: Sequence[str] = tuple(HISTORY_KEYS)) -> DataFrame:
    """Null the features a single transaction cannot have; leave the rest alone."""
    kinds = {f.name: f.dataType for f in features.schema.fields}
    return features.withColumns({c: F.lit(None).cast(kinds[c]) for c in columns if c in kinds})
