"""Table schemas, column families and the fixed values results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: results depend on them being exactly these -----------------
SECONDS_PER_HOUR = 3600
SECONDS_PER_DAY = 86400

FLAG_COLUMNS = ["M1", "M2", "M3", "M5", "M6", "M7", "M8", "M9"]
CARD_COLUMNS = ["card1", "card2", "card3", "card4", "card5", "card6"]
CATEGORICAL_COLUMNS = CARD_COLUMNS + [
    "addr1", "addr2", "P_emaildomain", "R_emaildomain", "ProductCD",
    "DeviceType", "DeviceInfo", "M4",
]
NUMERIC_IDENTITY_COLUMNS = [
    "id_01", "id_02", "id_03", "id_04", "id_05", "id_06", "id_07", "id_08",
    "id_09", "id_10", "id_11", "id_13", "id_14", "id_17", "id_18", "id_19",
    "id_20", "id_21", "id_22", "id_24", "id_25", "id_26", "id_32",
]
REQUIRED_FIELDS = ["TransactionID", "TransactionDT", "TransactionAmt"]

HOLDOUT_FRACTION = 0.20
VALIDATION_FRACTION = 0.10
REVIEW_FRACTIONS = [0.005, 0.01, 0.02, 0.05]
POLICY_FRACTION = 0.02
CALIBRATION_BINS = 10
IMPORTANCE_ROWS = 15
EXAMPLE_ROWS = 10
VERIFICATION_ROWS = 20
CHECK_ROWS, CHECK_POSITIVES, CHECK_POSITIVE_FLOOR = 500, 50, 40
SHIFT_THRESHOLD = 0.01
MAX_QUEUE_DROP = 0.02
DRIFT_TOLERANCE = 0.030
SEED = 26

MISSING_TEXT = "nan"
KEY_SEPARATOR = "||"
# A row's account: one card at one address, opened on one day.
ACCOUNT_KEYS = ["card1", "addr1", "start_day"]

# Feature name -> key columns counted over the training slice.
FREQUENCY_KEYS = {
    "card1_count": ["card1"],
    "addr1_count": ["addr1"],
    "P_emaildomain_count": ["P_emaildomain"],
    "uid_count": ACCOUNT_KEYS,
}

# Group name -> (key columns, statistics kept).
GROUP_KEYS = {
    "card1": (["card1"], ["mean_amt"]),
    "card1_addr1": (["card1", "addr1"], ["count", "mean_amt"]),
    "card1_P_emaildomain": (["card1", "P_emaildomain"], ["count", "mean_amt"]),
}

# Text columns whose lists of values are short by nature; all others may be as long as the data.
SHORT_LISTS = ["ProductCD", "card4", "card6", "DeviceType", "M4"]

HISTORY_KEYS = {
    "time_since_prev_card1": ["card1"],
    "time_since_prev_card1_addr1": ["card1", "addr1"],
}
# -----------------------------------------------------------------------------

ID, TIME, AMOUNT, LABEL = "TransactionID", "TransactionDT", "TransactionAmt", "isFraud"

_TEXT, _NUMBER, _WHOLE = T.StringType(), T.DoubleType(), T.LongType()


def _numbered(stem: str, last: int, kind: T.DataType = _NUMBER) -> dict[str, T.DataType]:
    return {f"{stem}{i}": kind for i in range(1, last + 1)}


# The columns of each table in file order, under the family they belong to.
_TRANSACTION = [
    ("other", {"ProductCD": _TEXT}),
    ("card", dict.fromkeys(CARD_COLUMNS, _NUMBER) | {"card1": _WHOLE, "card4": _TEXT, "card6": _TEXT}),
    ("addr", _numbered("addr", 2)),
    ("dist", _numbered("dist", 2)),
    ("email", {"P_emaildomain": _TEXT, "R_emaildomain": _TEXT}),
    ("C", _numbered("C", 14)),
    ("D", _numbered("D", 15)),
    ("M", _numbered("M", 9, _TEXT)),
    ("V", _numbered("V", 339)),
]
_IDENTITY = [
    ("identity", {
        name: _NUMBER if name in NUMERIC_IDENTITY_COLUMNS else _TEXT for name in (f"id_{i:02d}" for i in range(1, 39))
    }),
    ("device", {"DeviceType": _TEXT, "DeviceInfo": _TEXT}),
]
_FAMILY_OF = {name: family for family, columns in _TRANSACTION + _IDENTITY for name in columns}


def column_family(name: str) -> str:
    """The family a table declares the column under; columns of no table are "other"."""
    return _FAMILY_OF.get(name, "other")


def numeric_family_columns(columns: list[str]) -> list[str]:
    """The V, C and D columns present, each family in schema order."""
    return [c for family in ("V", "C", "D") for c in columns if column_family(c) == family]


def _struct(own: dict[str, T.DataType], families: list[tuple[str, dict[str, T.DataType]]]) -> T.StructType:
    required = {ID, TIME}
    columns = own | {name: kind for _, family in families for name, kind in family.items()}
    return T.StructType([T.StructField(n, t, n not in required) for n, t in columns.items()])


def transaction_schema(labelled: bool = True) -> T.StructType:
    label = {LABEL: T.IntegerType()} if labelled else {}
    return _struct({ID: _WHOLE} | label | {TIME: _WHOLE, AMOUNT: _NUMBER}, _TRANSACTION)


def identity_schema() -> T.StructType:
    return _struct({ID: _WHOLE}, _IDENTITY)
