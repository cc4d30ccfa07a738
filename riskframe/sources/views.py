"""Transaction and identity views over the generic test tables.

The tables hold no card data, so both engines derive the same views from
``events`` (and, for many equal times, from ``orders``).  ``TX_SQL`` is the DuckDB
form of what ``transactions`` and ``identities`` build in Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.sources.tables import nulls_for_nan


def _seconds_since(origin: str, column: str) -> str:
    """Whole seconds between two local times; no session time zone is involved."""
    return f"cast(cast({column} - timestamp_ntz'{origin} 00:00:00' AS interval second) AS bigint)"


_COLUMNS = [
    "event_id AS TransactionID",
    "CASE WHEN event_type = 'error' AND value > 80 OR event_id % 97 = 0 THEN 1 ELSE 0 END AS isFraud",
    _seconds_since("2024-01-01", "ts") + " + 86400 AS TransactionDT",
    "CASE WHEN event_id % 53 <> 0 THEN value END AS TransactionAmt",
    "event_type AS ProductCD",
    "user_id AS card1",
    "CASE WHEN k % 9 <> 0 THEN cast(k % 20 AS double) END AS addr1",
    "CASE WHEN k % 6 <> 0 THEN concat('mail', cast(k % 5 AS string), '.com') END AS P_emaildomain",
    "floor(value) * 1D AS C1",
    "CASE WHEN event_id % 17 <> 0 THEN cast(event_id % 10 AS double) / 2D END AS D1",
    "CASE event_id % 3 WHEN 0 THEN 'T' WHEN 1 THEN 'F' END AS M1",
    "CASE event_id % 4 WHEN 0 THEN 'M0' WHEN 1 THEN 'M1' WHEN 2 THEN 'M2' END AS M4",
    "value * k AS V1",
    "k",
    "least(1000L, 2 * cast(floor(value) AS bigint) + k) AS score_i",
]
RAW = ["TransactionID", "isFraud", "TransactionDT", "TransactionAmt", "ProductCD", "card1", "addr1", "P_emaildomain",
       "C1", "D1", "M1", "M4", "V1"]


def _events(spark: SparkSession, folder: str) -> DataFrame:
    raw = spark.read.parquet(f"{folder}/events.parquet")
    return raw.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return nulls_for_nan(_events(spark, folder).selectExpr(*_COLUMNS).select(*RAW))


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions with two scores in thousandths: ``score`` and a lower ``masked``."""
    rows = _events(spark, folder).selectExpr(*_COLUMNS)
    masked = F.greatest(F.lit(0), F.col("score_i") - F.col("TransactionID") % 7 * (F.col("TransactionID") % 5))
    return rows.select(
        *RAW, (F.col("score_i").cast("double") / 1000).alias("score"), (masked.cast("double") / 1000).alias("masked")
    )


def identities(spark: SparkSession, folder: str) -> DataFrame:
    """A quarter of the transactions has an identity row."""
    return _events(spark, folder).where("k < 25").selectExpr(
        "event_id AS TransactionID",
        "cast(-k AS double) AS id_01",
        "CASE WHEN k % 2 = 0 THEN 'mobile' ELSE 'desktop' END AS DeviceType",
    )


def order_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as transactions: about 60 share each time."""
    return spark.read.parquet(f"{folder}/orders.parquet").selectExpr(
        "o_orderkey AS TransactionID",
        _seconds_since("1990-01-01", "o_orderdate") + " AS TransactionDT",
        "o_custkey AS card1",
        "o_orderpriority AS addr1",
        "o_totalprice AS TransactionAmt",
        "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS isFraud",
    )


TX_SQL = """
base AS (SELECT *, cast(json_extract_string(props, '$.k') AS integer) AS k FROM events),
raw AS (
  SELECT event_id AS TransactionID,
    CASE WHEN event_type = 'error' AND value > 80 OR event_id % 97 = 0 THEN 1 ELSE 0 END AS isFraud,
    cast(floor(epoch(ts)) AS bigint) - 1704067200 + 86400 AS TransactionDT,
    CASE WHEN event_id % 53 <> 0 THEN value END AS TransactionAmt,
    event_type AS ProductCD, user_id AS card1,
    CASE WHEN k % 9 <> 0 THEN cast(k % 20 AS double) END AS addr1,
    CASE WHEN k % 6 <> 0 THEN concat('mail', k % 5, '.com') END AS P_emaildomain,
    cast(floor(value) AS double) AS C1,
    CASE WHEN event_id % 17 <> 0 THEN cast(event_id % 10 AS double) / cast(2 AS double) END AS D1,
    CASE event_id % 3 WHEN 0 THEN 'T' WHEN 1 THEN 'F' END AS M1,
    CASE event_id % 4 WHEN 0 THEN 'M0' WHEN 1 THEN 'M1' WHEN 2 THEN 'M2' END AS M4,
    value * k AS V1,
    least(1000, 2 * cast(floor(value) AS bigint) + k) AS score_i
  FROM base),
tx AS (
  SELECT * EXCLUDE (score_i), cast(score_i AS double) / cast(1000 AS double) AS score,
    cast(greatest(0, score_i - TransactionID % 7 * (TransactionID % 5)) AS double) / cast(1000 AS double) AS masked
  FROM raw),
idn AS (
  SELECT event_id AS TransactionID, cast(-k AS double) AS id_01,
    CASE WHEN k % 2 = 0 THEN 'mobile' ELSE 'desktop' END AS DeviceType
  FROM base WHERE k < 25),
otx AS (
  SELECT o_orderkey AS TransactionID, cast(epoch(o_orderdate) AS bigint) - 631152000 AS TransactionDT,
    o_custkey AS card1, o_orderpriority AS addr1, o_totalprice AS TransactionAmt,
    CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS isFraud
  FROM orders)"""

# Slices by global position in (time, id) order.
SPLIT_SQL = """
placed AS (
  SELECT *, row_number() OVER (ORDER BY TransactionDT, TransactionID) - 1 AS pos, count(*) OVER () AS n FROM {source}),
sized AS (
  SELECT *, n - cast(round_even(n * cast(0.2 AS double), 0) AS bigint) AS n_pool FROM placed),
sliced AS (
  SELECT * EXCLUDE (pos, n, n_pool), CASE
    WHEN pos < n_pool - cast(round_even(n_pool * cast(0.1 AS double), 0) AS bigint) THEN 'train'
    WHEN pos < n_pool THEN 'val' ELSE 'holdout' END AS split
  FROM sized)"""

# Row features with typed keys, and the maps fitted on training rows.
FEATURE_SQL = """
feat AS (
  SELECT *, cast(TransactionDT // 86400 AS integer) AS day_index,
    cast(ln(1 + CASE WHEN TransactionAmt < 0 THEN 0 ELSE TransactionAmt END) AS real) AS amt_log,
    round_even(cast(TransactionDT // 86400 AS double) - D1, 0) + cast(0 AS double) AS start_day
  FROM sliced),
fit AS (SELECT * FROM feat WHERE split = 'train'),
m_card1 AS (SELECT card1, count(*) AS cnt, avg(cast(amt_log AS double)) AS mean_amt FROM fit GROUP BY card1),
m_addr1 AS (SELECT addr1, count(*) AS cnt FROM fit GROUP BY addr1),
m_mail AS (SELECT P_emaildomain, count(*) AS cnt FROM fit GROUP BY P_emaildomain),
m_uid AS (SELECT card1, addr1, start_day, count(*) AS cnt FROM fit GROUP BY ALL),
m_card_addr AS (
  SELECT card1, addr1, count(*) AS cnt, avg(cast(amt_log AS double)) AS mean_amt FROM fit GROUP BY card1, addr1),
m_card_mail AS (
  SELECT card1, P_emaildomain, count(*) AS cnt, avg(cast(amt_log AS double)) AS mean_amt
  FROM fit GROUP BY card1, P_emaildomain)"""


def with_views(query: str, split: str | None = None, features: bool = False) -> str:
    """Prefix a DuckDB query with the views it reads; ``split`` names what is sliced."""
    parts = [TX_SQL]
    if split or features:
        parts.append(SPLIT_SQL.format(source=split or "tx"))
    if features:
        parts.append(FEATURE_SQL)
    body = query.strip()
    glue = ",\n" if body.startswith("+") else "\n"
    return "WITH " + ",".join(parts) + glue + body.removeprefix("+").strip()
