"""DuckDB SQL that states each registered query's result independently."""

from __future__ import annotations

from riskframe.sources.views import RAW, with_views

_TX = ", ".join(RAW)


def _tx(select: str) -> str:
    return with_views(f"SELECT {select} FROM tx")


def _held(query: str) -> str:
    return with_views(f"+ held AS (SELECT * FROM sliced WHERE split = 'holdout') {query}", split="tx")


def _feat(query: str) -> str:
    return with_views(query, features=True)


def _key(*columns: str) -> str:
    return "concat_ws('||', " + ", ".join(f"coalesce(cast({c} AS varchar), 'nan')" for c in columns) + ")"


_MAPS = f"""
SELECT 'card1_count' AS map, {_key('card1')} AS key, cnt FROM m_card1
UNION ALL SELECT 'addr1_count', {_key('addr1')}, cnt FROM m_addr1
UNION ALL SELECT 'P_emaildomain_count', {_key('P_emaildomain')}, cnt FROM m_mail
UNION ALL SELECT 'uid_count', {_key('card1', 'addr1', 'start_day')}, cnt FROM m_uid"""


def _areas(source: str, score: str) -> str:
    """One row: n, n_positive, roc_auc, average_precision."""
    return f"""
  SELECT cast(max(n_all) AS bigint) AS n, cast(max(n_pos) AS bigint) AS n_positive,
    sum(cast(pos AS double) * (cast(n_all - n_pos - (reached - tp) AS double) + cast(cnt - pos AS double) / 2))
      / (cast(max(n_pos) AS double) * cast(max(n_all) - max(n_pos) AS double)) AS roc_auc,
    sum(cast(pos AS double) * cast(tp AS double) / cast(reached AS double)) / cast(max(n_pos) AS double) AS average_precision
  FROM (
    SELECT pos, cnt, sum(pos) OVER down AS tp, sum(cnt) OVER down AS reached,
      sum(pos) OVER () AS n_pos, sum(cnt) OVER () AS n_all
    FROM (SELECT {score} AS s, sum(isFraud) AS pos, count(*) AS cnt FROM {source} WHERE {score} IS NOT NULL GROUP BY 1)
    WINDOW down AS (ORDER BY s DESC))"""


def _queue(source: str, score: str) -> str:
    return f"""
  SELECT f AS top_fraction, cast(k AS bigint) AS n_reviewed,
    cast(sum(CASE WHEN r <= k THEN isFraud ELSE 0 END) AS bigint) AS true_positives,
    round(cast(sum(CASE WHEN r <= k THEN isFraud ELSE 0 END) AS double) / k, 4) AS precision,
    round(cast(sum(CASE WHEN r <= k THEN isFraud ELSE 0 END) AS double) / nullif(sum(isFraud), 0), 4) AS recall
  FROM (
    SELECT o.*, f, greatest(1, cast(round_even(n * f, 0) AS bigint)) AS k FROM (
      SELECT isFraud, row_number() OVER (ORDER BY {score} DESC, TransactionID) AS r, count(*) OVER () AS n FROM {source}) o,
      (SELECT unnest([cast(0.005 AS double), cast(0.01 AS double), cast(0.02 AS double), cast(0.05 AS double)]) AS f))
  GROUP BY f, k"""


def _exact(value: str) -> str:
    """Mean of whole multiples of 1e-12, rounded half up to 6 digits."""
    n = f"cast(count({value}) AS hugeint)"
    total = f"sum(cast(round(({value}) * cast(1e12 AS double)) AS bigint))"
    return (f"cast((2 * {total} * 1000000 + {n} * 1000000000000) // (2 * {n} * 1000000000000) AS double)"
            " / cast(1000000 AS double)")


_BINS = f"""
  SELECT cast(bin AS integer) AS bin, count(*) AS count, {_exact('score')} AS mean_predicted,
    {_exact('isFraud')} AS observed_rate
  FROM (
    SELECT score, isFraud, (SELECT count(*) FROM range(1, 10) e(i) WHERE floor(i * (n / cast(10 AS double))) <= r) + 1 AS bin
    FROM (SELECT score, isFraud, row_number() OVER (ORDER BY score, TransactionID) - 1 AS r, count(*) OVER () AS n FROM held))
  GROUP BY bin"""

_EXAMPLES = """
  SELECT printf('HOLDOUT-%02d', row_number() OVER (ORDER BY r)) AS example_id, round(cast(amt_log AS double), 3) AS amount_log,
    ProductCD AS product_code, round(score, 6) AS calibrated_score, isFraud AS true_label
  FROM (
    SELECT *, cast(ln(1 + TransactionAmt) AS real) AS amt_log, row_number() OVER (ORDER BY score DESC, TransactionID) - 1 AS r,
      count(*) OVER () AS n FROM held)
  WHERE r IN (SELECT CASE WHEN i = 9 THEN n - 1 ELSE floor(i * ((n - 1) / cast(9 AS double))) END FROM range(0, 10) e(i))"""

_POLICY = """
policy AS (
  SELECT round(quantile_cont(score, cast(0.98 AS double)), 6) AS cutoff, quantile_cont(score, cast(0.98 AS double)) AS exact,
    count(*) AS n_val FROM sliced WHERE split = 'val')"""

_REALISED = """
  SELECT cast(0.02 AS double) AS top_fraction, cutoff AS fitted_cutoff, 'validation' AS fitted_on, n_val AS n_validation,
    round(cast(flagged AS double) / n, 4) AS review_rate, flagged AS n_reviewed, tp AS true_positives,
    round(cast(tp AS double) / nullif(flagged, 0), 4) AS precision, round(cast(tp AS double) / nullif(pos, 0), 4) AS recall
  FROM policy, (
    SELECT count(*) AS n, count(*) FILTER (score >= cutoff) AS flagged, count(*) FILTER (score >= cutoff AND isFraud = 1) AS tp,
      count(*) FILTER (isFraud = 1) AS pos FROM held, policy)"""

_EVALUATION = f"""
  held AS (SELECT * FROM sliced WHERE split = 'holdout'), {_POLICY},
  realised AS ({_REALISED}), queue AS ({_queue('held', 'score')}), bins AS ({_BINS}), areas AS ({_areas('held', 'score')}),
  size AS (
    SELECT count(*) AS n, cast(sum(isFraud) AS bigint) AS pos, {_exact('isFraud')} AS rate,
      {_exact('(score - isFraud) * (score - isFraud)')} AS brier FROM held)"""

_METRIC_VALUES = [
    ("holdout_n", "(SELECT n FROM size)"),
    ("holdout_positive_count", "(SELECT pos FROM size)"),
    ("holdout_positive_rate", "(SELECT rate FROM size)"),
    ("roc_auc", "(SELECT round(roc_auc, 6) FROM areas)"),
    ("pr_auc", "(SELECT round(average_precision, 6) FROM areas)"),
    ("brier_score", "(SELECT brier FROM size)"),
]
_TABLE_VALUES = [
    ("review_queue", """(SELECT to_json(list({'top_fraction': top_fraction, 'n_reviewed': n_reviewed,
        'true_positives': true_positives, 'precision': precision, 'recall': recall} ORDER BY top_fraction)) FROM queue)"""),
    ("calibration_table", """(SELECT to_json(list({'bin': bin, 'count': count, 'mean_predicted': mean_predicted,
        'observed_rate': observed_rate} ORDER BY bin)) FROM bins)"""),
] + [
    (f"review_policy.{c}", f"(SELECT {c} FROM realised)")
    for c in ("top_fraction", "fitted_cutoff", "fitted_on", "n_validation", "review_rate", "n_reviewed", "true_positives",
              "precision", "recall")
]


def _fields(values: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT '{path}' AS path, cast({value} AS varchar) AS value" for path, value in values)


_DOCUMENT = (
    [("model", "'transaction risk'")]
    + [(f"dataset_facts.{n}_rows", f"(SELECT count(*) FROM {t})") for n, t in (("transaction", "tx"), ("identity", "idn"))]
    + [("dataset_facts.transaction_columns", "13"), ("dataset_facts.identity_columns", "3")]
    + [("split.n_total", "(SELECT count(*) FROM tx)")]
    + [(f"split.n_{s}", f"(SELECT count(*) FROM sliced WHERE split = '{s}')") for s in ("train", "val", "holdout")]
    + [(f"metrics.{p}", v) for p, v in _METRIC_VALUES]
    + _TABLE_VALUES
    + [("example_rows", """(SELECT to_json(list({'example_id': example_id, 'amount_log': amount_log,
        'product_code': product_code, 'calibrated_score': calibrated_score, 'true_label': true_label} ORDER BY example_id))
        FROM examples)""")]
)

_LOOKUP = """
SELECT f.TransactionID, {columns} FROM feat f
LEFT JOIN m_card1 c1 ON f.card1 IS NOT DISTINCT FROM c1.card1
LEFT JOIN m_addr1 a1 ON f.addr1 IS NOT DISTINCT FROM a1.addr1
LEFT JOIN m_mail e1 ON f.P_emaildomain IS NOT DISTINCT FROM e1.P_emaildomain
LEFT JOIN m_uid u ON f.card1 IS NOT DISTINCT FROM u.card1 AND f.addr1 IS NOT DISTINCT FROM u.addr1
  AND f.start_day IS NOT DISTINCT FROM u.start_day
LEFT JOIN m_card_addr ca ON f.card1 IS NOT DISTINCT FROM ca.card1 AND f.addr1 IS NOT DISTINCT FROM ca.addr1
LEFT JOIN m_card_mail ce ON f.card1 IS NOT DISTINCT FROM ce.card1 AND f.P_emaildomain IS NOT DISTINCT FROM ce.P_emaildomain"""


def _mean(table: str) -> str:
    return f"round(cast(cast({table}.mean_amt AS real) AS double), 4)"


def _count(table: str) -> str:
    return f"cast(coalesce({table}.cnt, 0) AS double)"


_RATIO = "round(cast(cast(cast(f.amt_log AS double) / nullif(cast(cast(c1.mean_amt AS real) AS double), 0) AS real) AS double), 4)"


def _lag(source: str) -> str:
    return f"""
SELECT TransactionID,
  cast(TransactionDT - lag(TransactionDT) OVER (PARTITION BY card1 ORDER BY TransactionDT, TransactionID) AS double)
    AS time_since_prev_card1,
  cast(TransactionDT - lag(TransactionDT) OVER (PARTITION BY card1, addr1 ORDER BY TransactionDT, TransactionID) AS double)
    AS time_since_prev_card1_addr1
FROM {source}"""


_STRICT_JSON = """
SELECT TransactionID AS transaction_id, cast(to_json({'TransactionID': TransactionID, 'TransactionDT': TransactionDT,
  'TransactionAmt': CASE WHEN TransactionID % 31 <> 0 AND TransactionID % 37 <> 0 THEN TransactionAmt END,
  'ProductCD': ProductCD, 'card1': card1, 'addr1': addr1, 'P_emaildomain': P_emaildomain, 'D1': D1, 'M1': M1}) AS varchar)
  AS input, isFraud FROM tx"""

_FAMILIES = {
    "other": ["TransactionID", "isFraud", "TransactionDT", "TransactionAmt", "ProductCD"], "card": ["card1"],
    "addr": ["addr1"], "email": ["P_emaildomain"], "C": ["C1"], "D": ["D1"], "M": ["M1", "M4"], "V": ["V1"],
    "identity": ["id_01"], "device": ["DeviceType"],
}
_RATES = " UNION ALL ".join(
    f"SELECT '{family}' AS family, avg(CASE WHEN {c} IS NULL THEN cast(1 AS double) ELSE 0 END) AS r FROM merged"
    for family, names in _FAMILIES.items() for c in names
)
_MERGED = "+ merged AS (SELECT tx.*, id_01, DeviceType FROM tx LEFT JOIN idn USING (TransactionID))"

_SPACED = """
  SELECT TransactionID, TransactionDT, isFraud FROM (
    SELECT *, row_number() OVER (PARTITION BY isFraud ORDER BY TransactionDT, TransactionID) - 1 AS r,
      count(*) OVER (PARTITION BY isFraud) AS m, CASE isFraud WHEN 1 THEN 50 ELSE 450 END AS k FROM held)
  WHERE k >= m OR r IN (
    SELECT CASE WHEN i = k - 1 THEN m - 1 ELSE floor(i * ((m - 1) / cast(k - 1 AS double))) END
    FROM range(0, 450) e(i) WHERE i < k)"""

_CODES = """
SELECT 'ProductCD' AS "column", ProductCD AS value, cast(row_number() OVER (ORDER BY ProductCD) - 1 AS bigint) AS code
  FROM (SELECT DISTINCT ProductCD FROM fit WHERE ProductCD IS NOT NULL)
UNION ALL SELECT 'P_emaildomain', P_emaildomain, cast(row_number() OVER (ORDER BY P_emaildomain) - 1 AS bigint)
  FROM (SELECT DISTINCT P_emaildomain FROM fit WHERE P_emaildomain IS NOT NULL)
UNION ALL SELECT 'M4', M4, cast(row_number() OVER (ORDER BY M4) - 1 AS bigint)
  FROM (SELECT DISTINCT M4 FROM fit WHERE M4 IS NOT NULL)
UNION ALL SELECT 'card1', v, cast(row_number() OVER (ORDER BY v) - 1 AS bigint)
  FROM (SELECT DISTINCT cast(card1 AS varchar) AS v FROM fit WHERE card1 IS NOT NULL)"""

_HOUR = "cast((TransactionDT % 86400) // 3600 AS double)"
_DAY = "cast(TransactionDT // 86400 AS integer)"
_START = f"round_even(cast({_DAY} AS double) - D1, 0) + cast(0 AS double)"
_PROFILE = """SELECT count(*) AS n_rows, cast(sum(isFraud) AS bigint) AS n_positive,
  round(cast(sum(isFraud) AS double) / count(*), 6) AS positive_rate, min(TransactionDT) AS first_time,
  max(TransactionDT) AS last_time"""


def _shift(score_a: str = "score", score_b: str = "masked") -> str:
    return f"""
  top AS (
    SELECT *, row_number() OVER (ORDER BY {score_a} DESC, TransactionID) AS ra,
      row_number() OVER (ORDER BY {score_b} DESC, TransactionID) AS rb,
      greatest(1, cast(round_even(count(*) OVER () * cast(0.02 AS double), 0) AS bigint)) AS k FROM held)"""


def _drift(name: str, source: str, areas: str) -> str:
    return f"""
SELECT '{name}' AS release, 'canary' AS kind, n, 'roc_auc' AS metric, recorded, observed, cast(0.03 AS double) AS tolerance,
  errors = 0 AND coalesce(abs(observed - recorded) <= 0.03, false) AS match, p50_ms, p95_ms, errors, duration_s
FROM (SELECT count(*) AS n, count(*) FILTER (s IS NULL) AS errors, round(sum(elapsed) / 1000, 1) AS duration_s FROM {source}),
  (SELECT round(roc_auc, 6) AS observed FROM {areas}), (SELECT round(roc_auc, 6) AS recorded FROM val_areas),
  (SELECT cast(max(elapsed) FILTER (r = least(floor(n * 0.5), n - 1)) AS bigint) AS p50_ms,
     cast(max(elapsed) FILTER (r = least(floor(n * cast(0.95 AS double)), n - 1)) AS bigint) AS p95_ms
   FROM (SELECT elapsed, row_number() OVER (ORDER BY elapsed, TransactionID) - 1 AS r, count(*) OVER () AS n FROM {source}))"""


def _compared(left: str, right: str) -> str:
    """Full outer comparison of two (TransactionID, s, f) tables."""
    return f"""
compared AS (
  SELECT coalesce(l.TransactionID, r.TransactionID) AS TransactionID, l.s AS left_score, l.f AS left_flag,
    r.s AS right_score, r.f AS right_flag, l.TransactionID IS NOT NULL AS in_left, r.TransactionID IS NOT NULL AS in_right,
    abs(l.s - r.s) AS abs_diff,
    CASE WHEN l.TransactionID IS NOT NULL AND r.TransactionID IS NOT NULL THEN l.f IS DISTINCT FROM r.f END AS flag_differs
  FROM ({left}) l FULL JOIN ({right}) r ON l.TransactionID = r.TransactionID),
judged AS (
  SELECT *, NOT in_left OR NOT in_right OR coalesce(abs_diff <> 0, false) OR coalesce(flag_differs, false) AS mismatch
  FROM compared)"""


ORACLES: dict[str, str] = {
    "A1_csv_scan": _tx(_TX),
    "A8_model_store": with_views("SELECT count(*) AS n_ids, cast(0 AS bigint) AS n_mismatches FROM tx"),
    "F7_feature_importance": "SELECT cast(i AS integer) AS rank, true AS share_in_range, true AS gain_counts FROM range(1, 16) t(i)",
    "G1_train_trees": _held(
        "SELECT count(*) AS n, cast(sum(isFraud) AS bigint) AS n_positive, true AS better_than_chance, true AS ranks_well, true AS rounds_within_limit FROM held"),
    "G1_model_inputs": _feat("+ texts AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS name, '{route}' AS route, count(DISTINCT {value}) AS n_values FROM fit" for c, route, value in (
            ("ProductCD", "short list", "ProductCD"), ("M4", "short list", "M4"), ("card1", "code and count", "card1"),
            ("addr1", "code and count", "addr1"), ("P_emaildomain", "code and count", "P_emaildomain"),
            ("uid", "code and count", _key("card1", "addr1", "start_day"))))
        + """) SELECT name AS "column", route, n_values FROM texts"""),
    "G2_raw_scores": _tx("TransactionID, isFraud, true AS in_range"),
    "G3_isotonic_fit": with_views("SELECT count(*) AS n, cast(0 AS bigint) AS n_apart FROM tx"),
    "G4_calibrated_scores": _held("SELECT TransactionID, isFraud, true AS in_range, true AS flag_fits FROM held"),
    "G5_calibrator_thresholds": "SELECT true AS x_rises, true AS y_never_falls, true AS y_in_range",
    "G8_batch_scores": with_views(
        "SELECT TransactionID, true AS in_range, true AS has_flag FROM tx WHERE TransactionAmt IS NOT NULL"),
    "G9_stream_scores": with_views(
        "SELECT count(*) AS n_ids, cast(0 AS bigint) AS n_mismatches FROM tx WHERE TransactionAmt IS NOT NULL"),
    "H5_queue_pair": _held(f""", a AS ({_queue('held', 'score')}), b AS ({_queue('held', 'masked')})
SELECT top_fraction, a.n_reviewed, a.true_positives AS first_true_positives, a.precision AS first_precision,
  a.recall AS first_recall, b.true_positives AS second_true_positives, b.precision AS second_precision, b.recall AS second_recall
FROM a JOIN b USING (top_fraction)"""),
    "A1_csv_layouts": _tx("""TransactionID, isFraud, TransactionDT, TransactionAmt,
  CASE WHEN TransactionID % 2 = 0 OR TransactionID % 31 <> 0 THEN C1 END AS C1, ProductCD,
  CASE WHEN TransactionID % 2 = 1 AND TransactionID % 31 = 0 THEN 'C1' ELSE '' END AS bad"""),
    "G8_batch_rejects": with_views("SELECT TransactionID, 'missing TransactionAmt' AS reasons FROM tx WHERE TransactionAmt IS NULL"),
    "G9_stream_rejects": with_views("SELECT TransactionID, 'missing TransactionAmt' AS reasons FROM tx WHERE TransactionAmt IS NULL"),
    "A1_csv_malformed": with_views("""+
lines AS (
  SELECT *, concat(CASE WHEN TransactionID % 41 = 0 THEN '"' ELSE '' END,
      CASE WHEN TransactionID % 43 = 0 THEN concat('"', ProductCD, ', ""so""', '"') ELSE ProductCD END) AS product,
    concat_ws(',', TransactionID, isFraud, TransactionDT, card1, product) AS good,
    CASE WHEN TransactionID % 31 = 0 THEN concat(good, ',more') WHEN TransactionID % 37 = 0 THEN concat_ws(',', TransactionID, TransactionDT)
      WHEN TransactionID % 41 = 0 THEN good END AS line
  FROM tx)
SELECT line, CASE WHEN line IS NULL THEN TransactionID END AS TransactionID, CASE WHEN line IS NULL THEN isFraud END AS isFraud,
  CASE WHEN line IS NULL THEN TransactionDT END AS TransactionDT, CASE WHEN line IS NULL THEN card1 END AS card1,
  CASE WHEN line IS NULL THEN ProductCD || CASE WHEN TransactionID % 43 = 0 THEN ', "so"' ELSE '' END END AS ProductCD
FROM lines"""),
    "A9_strict_json_nested": with_views("""+
numbers AS (
  SELECT TransactionID AS i, ProductCD, coalesce(floor(TransactionAmt)::varchar, 'null') AS good,
    CASE WHEN TransactionID % 31 = 0 OR TransactionID % 37 = 0 THEN 'null' ELSE good END AS v FROM tx)
SELECT i AS transaction_id, concat('{"amounts":[', good, ',', v, '],"one":',
  CASE WHEN i % 5 <> 0 THEN concat('{"value":', v, ',"kind":"', ProductCD, '"}') ELSE 'null' END,
  ',"many":[{"deep":[', v, ',2.5],"id":', i, '}],"by_kind":{"', ProductCD, '":', v, '}}') AS input
FROM numbers"""),
    "A2_csv_pruned_scan": _tx("TransactionID, isFraud, TransactionDT"),
    "A3_parquet_scan": "SELECT * REPLACE (strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts) FROM events",
    "A4_parquet_sink": with_views(f"SELECT {_TX}, id_01, DeviceType FROM tx LEFT JOIN idn USING (TransactionID)"),
    "A5_fitted_maps_store": _feat(f"""
SELECT map, key, cnt, cast(NULL AS double) AS mean_amt FROM ({_MAPS})
UNION ALL SELECT 'group_card1', {_key('card1')}, cnt, round(mean_amt, 6) FROM m_card1
UNION ALL SELECT 'group_card1_addr1', {_key('card1', 'addr1')}, cnt, round(mean_amt, 6) FROM m_card_addr
UNION ALL SELECT 'group_card1_P_emaildomain', {_key('card1', 'P_emaildomain')}, cnt, round(mean_amt, 6) FROM m_card_mail"""),
    "A6_json_report": with_views(f"{_PROFILE} FROM tx"),
    "A7_split_store": with_views("SELECT TransactionID, split FROM sliced", split="tx"),
    "A9_strict_json": with_views(_STRICT_JSON),
    "A10_run_ledger": with_views("""
SELECT *, ts = max(ts) OVER () AS is_latest FROM (
  SELECT max(TransactionDT) AS ts, split AS run, count(*) AS n, round(avg(cast(isFraud AS double)), 6) AS positive_rate
  FROM sliced GROUP BY split)""", split="tx"),
    "A11_report_document": with_views(
        f"+ {_EVALUATION}, examples AS ({_EXAMPLES}) {_fields(_DOCUMENT)}", split="tx"),
    "B1_table_profile": with_views("""
SELECT *, n_rows <> expected_rows AS mismatch FROM (
  SELECT 'transactions' AS table_name, (SELECT count(*) FROM tx) AS n_rows, 13 AS n_columns, true AS has_label,
    cast(10000 AS bigint) AS expected_rows
  UNION ALL SELECT 'identities', (SELECT count(*) FROM idn), 3, false, 2500
  UNION ALL SELECT 'orders', (SELECT count(*) FROM otx), 6, true, 15000)"""),
    "B3_label_profile": with_views(f"{_PROFILE} FROM tx"),
    "B4_identity_coverage": with_views("""
SELECT n_rows, n_with_identity, round(100 * cast(n_with_identity AS double) / n_rows, 3) AS pct_with_identity FROM (
  SELECT count(*) AS n_rows, count(*) FILTER (TransactionID IN (SELECT TransactionID FROM idn)) AS n_with_identity FROM tx)"""),
    "B5_marker_rows": with_views(_MERGED + """
SELECT count(*) AS n_rows, count(id_01) AS n_with_marker, 'merged' AS source FROM merged
UNION ALL SELECT count(*), cast(NULL AS bigint), 'unmerged' FROM tx"""),
    "B6_missing_rate_by_family": with_views(_MERGED + f"""
SELECT family, count(*) AS n_columns, round(avg(r), 4) AS mean_missing_rate, round(min(r), 4) AS min_missing_rate,
  round(max(r), 4) AS max_missing_rate FROM ({_RATES}) GROUP BY family"""),
    "B8_selection_checks": _held(f"""
SELECT *, size_ok AND positives_ok AND ids_ok AS passes FROM (
  SELECT *, n_rows = 500 AS size_ok, n_positive >= 40 AS positives_ok, n_ids = n_rows AS ids_ok FROM (
    SELECT count(*) AS n_rows, cast(coalesce(sum(isFraud), 0) AS bigint) AS n_positive, count(DISTINCT TransactionID) AS n_ids
    FROM ({_SPACED})))"""),
    "C1_identity_join": with_views(f"SELECT {_TX}, id_01, DeviceType FROM tx LEFT JOIN idn USING (TransactionID)"),
    "C2_frequency_lookup": _feat(_LOOKUP.format(columns=", ".join(
        f"{_count(t)} AS {n}" for t, n in (("c1", "card1_count"), ("a1", "addr1_count"), ("e1", "P_emaildomain_count"),
                                           ("u", "uid_count"))))),
    "C3_group_lookup": _feat(_LOOKUP.format(columns=(
        f"{_mean('c1')} AS card1_mean_amt, {_count('ca')} AS card1_addr1_count, {_mean('ca')} AS card1_addr1_mean_amt, "
        f"{_count('ce')} AS card1_P_emaildomain_count, {_mean('ce')} AS card1_P_emaildomain_mean_amt"))),
    "C5_calibration_curve": with_views("""+
curve AS (SELECT min(score) AS x, cast(sum(isFraud) AS double) / count(*) AS y FROM tx GROUP BY floor(score * 10)),
segments AS (SELECT x AS x0, y AS y0, lead(x) OVER (ORDER BY x) AS x1, lead(y) OVER (ORDER BY x) AS y1 FROM curve),
ends AS (SELECT min(x) AS lo, max(x) AS hi, min_by(y, x) AS y_lo, max_by(y, x) AS y_hi FROM curve)
SELECT TransactionID, masked, round(CASE WHEN masked <= lo THEN y_lo WHEN masked >= hi THEN y_hi
  ELSE (SELECT y0 + (masked - x0) * (y1 - y0) / (x1 - x0) FROM segments WHERE masked >= x0 AND masked < x1) END, 6) AS calibrated
FROM tx, ends"""),
    "C6_score_comparison": with_views("+" + _compared(
        "SELECT TransactionID, score AS s, score >= 0.1 AS f FROM tx WHERE addr1 IS NOT NULL",
        "SELECT TransactionID, masked AS s, masked >= 0.1 AS f FROM tx WHERE P_emaildomain IS NOT NULL",
    ) + " SELECT * FROM judged"),
    "D1_drop_label": _tx(_TX.replace("isFraud, ", "")),
    "D2_strict_cast": with_views("SELECT TransactionID, TransactionDT FROM tx WHERE TransactionID % 29 <> 0"),
    "D3_hour_of_day": _tx(f"TransactionID, {_HOUR} AS hour_of_day"),
    "D4_day_index": _tx(f"TransactionID, {_DAY} AS day_index"),
    "D5_lenient_number": _tx("""TransactionID, CASE WHEN TransactionID % 11 = 0 OR TransactionID % 13 = 0 THEN NULL
  WHEN TransactionID % 7 = 0 THEN TransactionAmt WHEN TransactionID % 19 = 0 THEN NULL ELSE TransactionAmt END AS amount"""),
    "D6_clip_at_zero": _tx("""TransactionID, CASE WHEN TransactionAmt - 20 < 0 THEN cast(0 AS double)
  ELSE TransactionAmt - 20 END AS clipped"""),
    "D7_log_amount": _tx("""TransactionID, round(cast(cast(ln(1 + CASE WHEN TransactionAmt - 20 < 0 THEN cast(0 AS double)
  ELSE TransactionAmt - 20 END) AS real) AS double), 6) AS amt_log"""),
    "D8_numeric_families": _tx("TransactionID, " + ", ".join(
        f"cast(cast({c} AS real) AS double) AS {c}" for c in ("V1", "C1", "D1"))),
    "D9_flags": _tx("TransactionID, CASE M1 WHEN 'T' THEN cast(1 AS double) WHEN 'F' THEN cast(0 AS double) END AS M1"),
    "D10_categories": _tx("TransactionID, cast(card1 AS varchar) AS card1, cast(addr1 AS varchar) AS addr1, P_emaildomain, ProductCD, M4"),
    "D11_numeric_identity": with_views(
        "SELECT TransactionID, id_01 FROM tx LEFT JOIN idn USING (TransactionID)"),
    "D12_missing_text": _tx(f"TransactionID, {_key('addr1')} AS addr1_key, {_key('P_emaildomain')} AS P_emaildomain_key"),
    "D13_composite_key": _tx(f"TransactionID, {_key('card1', 'addr1')} AS card1_addr1"),
    "D14_account": with_views(f"""
SELECT TransactionID, start_day, {_key('card1', 'addr1', 'start_day')} AS uid
FROM (SELECT *, {_START} AS start_day FROM tx)"""),
    "D15_amount_ratio": _feat(_LOOKUP.format(columns=f"{_RATIO} AS ratio")),
    "D16_float_edge": _tx("TransactionID, " + ", ".join(
        f"cast(cast({c} AS real) AS double) AS {c}" for c in ("TransactionAmt", "V1", "C1", "D1"))),
    "D17_align_columns": _tx(f"""TransactionID, cast(cast(V1 AS real) AS double) AS V1,
  round(cast(cast(ln(1 + TransactionAmt) AS real) AS double), 6) AS amt_log, cast(NULL AS double) AS V2,
  cast(NULL AS varchar) AS R_emaildomain, {_HOUR} AS hour_of_day"""),
    "D18_required_fields": _tx("""TransactionID, TransactionID % 29 <> 0 AND TransactionAmt IS NOT NULL AS valid,
  concat_ws(',', CASE WHEN TransactionID % 29 = 0 THEN 'missing TransactionDT' END,
    CASE WHEN TransactionAmt IS NULL THEN 'missing TransactionAmt' END) AS reasons"""),
    "D19_mask_history": _tx("""TransactionID, card1, cast(NULL AS double) AS time_since_prev_card1,
  cast(NULL AS double) AS time_since_prev_card1_addr1"""),
    "D21_review_flag": _tx("""TransactionID, score >= cast(0.2 AS double) AS flag_default,
  score >= cast(0.37 AS double) AS flag_strict"""),
    "D22_report_rounding": _tx("TransactionID, " + ", ".join(f"round(V1 / 7, {n}) AS v_{n}" for n in (3, 4, 6))),
    "D23_category_code": _feat(f"""+ codes AS ({_CODES})
SELECT f.TransactionID, p.code AS ProductCD_code, e.code AS P_emaildomain_code, c.code AS card1_code FROM feat f
LEFT JOIN codes p ON p."column" = 'ProductCD' AND p.value = f.ProductCD
LEFT JOIN codes e ON e."column" = 'P_emaildomain' AND e.value = f.P_emaildomain
LEFT JOIN codes c ON c."column" = 'card1' AND c.value = cast(f.card1 AS varchar)"""),
    "E1_frequency_maps": _feat(_MAPS),
    "E2_group_counts": _feat(f"""
SELECT 'card1_addr1' AS map, {_key('card1', 'addr1')} AS key, cnt FROM m_card_addr
UNION ALL SELECT 'card1_P_emaildomain', {_key('card1', 'P_emaildomain')}, cnt FROM m_card_mail"""),
    "E3_group_means": _feat(f"""
SELECT 'card1' AS map, {_key('card1')} AS key, round(mean_amt, 6) AS mean_amt FROM m_card1
UNION ALL SELECT 'card1_addr1', {_key('card1', 'addr1')}, round(mean_amt, 6) FROM m_card_addr
UNION ALL SELECT 'card1_P_emaildomain', {_key('card1', 'P_emaildomain')}, round(mean_amt, 6) FROM m_card_mail"""),
    "E4_self_fit": with_views(f"""+
f AS (SELECT *, cast(ln(1 + TransactionAmt) AS real) AS amt_log, {_START} AS start_day FROM tx),
g AS (
  SELECT *, count(*) OVER (PARTITION BY card1) AS n1, count(*) OVER (PARTITION BY card1, addr1, start_day) AS nu,
    count(*) OVER (PARTITION BY card1, addr1) AS na,
    cast(avg(cast(amt_log AS double)) OVER (PARTITION BY card1) AS real) AS mean1,
    TransactionDT - lag(TransactionDT) OVER (PARTITION BY card1, addr1 ORDER BY TransactionDT, TransactionID) AS gap FROM f)
SELECT TransactionID, {_key('card1', 'addr1', 'start_day')} AS uid, cast(n1 AS double) AS card1_count,
  cast(nu AS double) AS uid_count, cast(na AS double) AS card1_addr1_count, cast(gap AS double) AS time_since_prev_card1_addr1,
  round(cast(mean1 AS double), 4) AS card1_mean_amt,
  round(cast(cast(cast(amt_log AS double) / nullif(cast(mean1 AS double), 0) AS real) AS double), 4) AS amt_to_card1_mean_ratio
FROM g"""),
    "E5_positive_weight": with_views("""
SELECT p AS n_positive, n - p AS n_negative, round(cast(n - p AS double) / greatest(p, 1), 6) AS positive_weight FROM (
  SELECT count(*) AS n, cast(sum(isFraud) AS bigint) AS p FROM sliced WHERE split = 'train')""", split="tx"),
    "E6_split_summary": with_views(
        _PROFILE.replace("SELECT", "SELECT split,", 1) + " FROM sliced GROUP BY split", split="tx"),
    "E6_split_record": with_views("""
SELECT count(*) AS n_total, count(*) FILTER (split = 'train') AS n_train, count(*) FILTER (split = 'val') AS n_val,
  count(*) FILTER (split = 'holdout') AS n_holdout, max(TransactionDT) FILTER (split <> 'holdout') AS holdout_cutoff_dt,
  max(TransactionDT) FILTER (split = 'train') AS val_cutoff_dt,
  round(avg(cast(isFraud AS double)) FILTER (split = 'train'), 6) AS train_positive_rate,
  round(avg(cast(isFraud AS double)) FILTER (split = 'val'), 6) AS val_positive_rate,
  round(cast(count(*) FILTER (split = 'train' AND isFraud = 0) AS double)
    / greatest(count(*) FILTER (split = 'train' AND isFraud = 1), 1), 6) AS positive_weight
FROM sliced""", split="tx"),
    "E7_percentile_cutoff": with_views(f"""+ {_POLICY}
SELECT n_val AS n, cutoff, (SELECT count(*) FROM sliced WHERE split = 'val' AND score >= exact) AS n_at_or_above
FROM policy""", split="tx"),
    "E8_brier_score": with_views(f"SELECT {_exact('(score - isFraud) * (score - isFraud)')} AS brier_score FROM tx"),
    "F1_time_since_previous": with_views(_lag("tx")),
    "F1_time_since_previous_hot": with_views(_lag("tx")),
    "F1_time_since_previous_ties": with_views(_lag("otx")),
    "F1_time_since_previous_stream": with_views(_lag("tx")),
    "F1_late_rows_stream": with_views("""
SELECT TransactionID, TransactionDT, CASE WHEN split = 'val' AND TransactionDT < (SELECT max(TransactionDT) FROM sliced) THEN 'late'
  ELSE 'rows' END AS routed_to FROM sliced""", split="tx"),
    "F2_time_split": with_views("SELECT TransactionID, TransactionDT, split FROM sliced", split="tx"),
    "F2_time_split_ties": with_views("SELECT TransactionID, TransactionDT, split FROM sliced", split="otx"),
    "F3_review_queue": _held(_queue("held", "score")),
    "F4_calibration_table": _held(_BINS),
    "F5_score_examples": _held(_EXAMPLES),
    "F6_stratified_sample": _held(_SPACED),
    "F8_first_in_time": _held(
        "SELECT TransactionID, TransactionDT, isFraud, score FROM held ORDER BY TransactionDT, TransactionID LIMIT 20"),
    "F9_top_overlap": _held(f""", {_shift()}
SELECT max(k) AS k, count(*) FILTER (ra <= k AND rb <= k) AS n_both,
  round(cast(count(*) FILTER (ra <= k AND rb <= k) AS double) / max(k), 6) AS overlap FROM top"""),
    "F10_nearest_rank": _held("""
SELECT max(n) AS n, cast(max(e) FILTER (r = least(floor(n * 0.5), n - 1)) AS bigint) AS p50_ms,
  cast(max(e) FILTER (r = least(floor(n * cast(0.95 AS double)), n - 1)) AS bigint) AS p95_ms
FROM (SELECT e, row_number() OVER (ORDER BY e, TransactionID) - 1 AS r, count(*) OVER () AS n
  FROM (SELECT TransactionID, 100 + TransactionID % 60 AS e FROM held))"""),
    "H1_roc_auc": with_views(f"SELECT n, n_positive, round(roc_auc, 6) AS roc_auc FROM ({_areas('tx', 'score')})"),
    "H2_average_precision": with_views(
        f"SELECT n, n_positive, round(average_precision, 6) AS average_precision FROM ({_areas('tx', 'score')})"),
    "H3_evaluation_record": with_views(f"+ {_EVALUATION} {_fields(_METRIC_VALUES + _TABLE_VALUES)}", split="tx"),
    "G6_category_dictionary": _feat(_CODES),
    "G7_review_policy": with_views(f"""+ {_POLICY}
SELECT cast(0.02 AS double) AS top_fraction, cutoff AS fitted_cutoff, 'validation' AS fitted_on, n_val AS n_validation
FROM policy""", split="tx"),
    "H4_policy_metrics": _held(f", {_POLICY} {_REALISED}"),
    "H5_score_shift": _held(f""", {_shift()}, a AS ({_areas('held', 'score')}), b AS ({_areas('held', 'masked')})
SELECT count(*) AS n, {_exact('abs(score - masked)')} AS mean_abs_shift, round(max(abs(score - masked)), 6) AS max_abs_shift,
  {_exact('CASE WHEN abs(score - masked) > cast(0.01 AS double) THEN cast(1 AS double) ELSE 0 END')} AS share_shifted,
  round(cast(count(*) FILTER (ra <= k AND rb <= k) AS double) / max(k), 6) AS top_overlap,
  round((SELECT roc_auc FROM a), 6) AS first_roc_auc, round((SELECT average_precision FROM a), 6) AS first_pr_auc,
  round((SELECT roc_auc FROM b), 6) AS second_roc_auc, round((SELECT average_precision FROM b), 6) AS second_pr_auc
FROM top"""),
    "H6_release_gate": _held(f""", qa AS ({_queue('held', 'score')}), qb AS ({_queue('held', 'masked')})
SELECT qa.precision - qb.precision <= cast(0.02 AS double) AND qa.recall - qb.recall <= cast(0.02 AS double) AS passes,
  cast(0.02 AS double) AS max_allowed_drop, round(qa.precision - qb.precision, 6) AS precision_drop,
  round(qa.recall - qb.recall, 6) AS recall_drop
FROM qa JOIN qb USING (top_fraction) WHERE abs(top_fraction - cast(0.02 AS double)) < 1e-6"""),
    "H7_drift_record": _held(f""",
answered AS (SELECT TransactionID, isFraud, score AS s, cast(100 + TransactionID % 60 AS double) AS elapsed FROM held),
failing AS (SELECT * REPLACE (CASE WHEN TransactionID % 211 <> 0 THEN s END AS s) FROM answered),
val AS (SELECT * FROM sliced WHERE split = 'val'),
val_areas AS ({_areas('val', 'score')}), answered_areas AS ({_areas('answered', 's')}), failing_areas AS ({_areas('failing', 's')})
{_drift('answered', 'answered', 'answered_areas')} UNION ALL {_drift('with errors', 'failing', 'failing_areas')}"""),
    "H7_drift_windows": with_views("""+
answers AS (
  SELECT TransactionDT // 604800 AS w, isFraud, CASE WHEN TransactionID % 211 <> 0 THEN score END AS s, 100 + TransactionID % 60 AS e FROM tx),
sums AS (SELECT w, s, count(*) AS cnt, sum(isFraud) AS pos FROM answers WHERE s IS NOT NULL GROUP BY w, s),
below AS (SELECT *, sum(cnt - pos) OVER (PARTITION BY w ORDER BY s) - (cnt - pos) AS neg_below FROM sums),
areas AS (
  SELECT w, round(sum(pos * (cast(neg_below AS double) + cast(cnt - pos AS double) / 2))
    / nullif(cast(sum(pos) AS double) * sum(cnt - pos), 0), 6) AS observed FROM below GROUP BY w),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY w ORDER BY e) - 1 AS r, count(*) OVER (PARTITION BY w) AS m FROM answers),
timed AS (
  SELECT w, count(*) AS n, count(*) FILTER (s IS NULL) AS errors, round(sum(cast(e AS double)) / 1000, 1) AS duration_s,
    max(e) FILTER (r = least(floor(m * cast(0.5 AS double)), m - 1)) AS p50_ms,
    max(e) FILTER (r = least(floor(m * cast(0.95 AS double)), m - 1)) AS p95_ms
  FROM ranked GROUP BY w)
SELECT w * 604800 AS window_from, (w + 1) * 604800 AS window_to, n, cast(0.75 AS double) AS recorded, observed,
  cast(0.03 AS double) AS tolerance, errors = 0 AND coalesce(abs(observed - cast(0.75 AS double)) <= cast(0.03 AS double), false) AS match,
  p50_ms, p95_ms, errors, duration_s
FROM timed LEFT JOIN areas USING (w) WHERE (w + 1) * 604800 <= (SELECT max(TransactionDT) FROM tx)"""),
    "G9_stream_routed": with_views("""
SELECT TransactionID, CASE WHEN TransactionAmt IS NULL THEN 'rejected' ELSE 'scored' END AS routed_to,
  CASE WHEN TransactionAmt IS NULL THEN 'missing TransactionAmt' ELSE '' END AS reasons, true AS as_in_table FROM tx"""),
    "H8_service_parity": with_views("+" + _compared(
        "SELECT TransactionID, round(score, 6) AS s, score >= cast(0.2 AS double) AS f FROM tx",
        """SELECT TransactionID, round(o, 6) AS s, o >= cast(0.2 AS double) AS f FROM (SELECT TransactionID, score
          + CASE WHEN TransactionID % 499 = 0 THEN cast(0.001 AS double) ELSE cast(1e-9 AS double) END AS o FROM tx)""",
    ) + """
SELECT *, n_mismatches = 0 AS passes FROM (
  SELECT count(*) AS n_ids, count(*) FILTER (NOT in_right) AS n_only_left, count(*) FILTER (NOT in_left) AS n_only_right,
    round(max(abs_diff), 6) AS max_abs_diff, count(*) FILTER (flag_differs) AS n_flag_mismatches,
    count(*) FILTER (mismatch) AS n_mismatches FROM judged)"""),
    "flagship_queue_profile": _feat(f"""+ joined AS ({_LOOKUP.format(columns=f'''f.split, f.isFraud, f.score,
    coalesce(c1.cnt, 0) AS card1_count, coalesce(u.cnt, 0) AS uid_count, cast(ca.mean_amt AS real) AS mean_ca,
    cast(cast(f.amt_log AS double) / nullif(cast(cast(c1.mean_amt AS real) AS double), 0) AS real) AS ratio''')}),
lagged AS ({_lag('tx')}),
ranked AS (
  SELECT j.*, l.* EXCLUDE (TransactionID), row_number() OVER (ORDER BY score DESC, j.TransactionID)
      <= greatest(1, cast(round_even(count(*) OVER () * cast(0.02 AS double), 0) AS bigint)) AS in_queue
  FROM joined j JOIN lagged l USING (TransactionID) WHERE split = 'holdout')
SELECT in_queue, count(*) AS n_rows, cast(sum(isFraud) AS bigint) AS n_positive, round(avg(cast(isFraud AS double)), 6) AS precision,
  round(avg(cast(card1_count AS double)), 4) AS mean_card1_count, round(avg(cast(uid_count AS double)), 4) AS mean_uid_count,
  round(avg(cast(mean_ca AS double)), 4) AS mean_card1_addr1_mean_amt,
  round(avg(cast(ratio AS double)), 4) AS mean_amt_to_card1_mean_ratio,
  round(avg(time_since_prev_card1), 4) AS mean_time_since_prev_card1,
  round(avg(time_since_prev_card1_addr1), 4) AS mean_time_since_prev_card1_addr1
FROM ranked GROUP BY in_queue"""),
}
ORACLES |= {
    "A7_split_store_buckets": ORACLES["F2_time_split"],
    "C1_identity_join_buckets": ORACLES["C1_identity_join"],
    "C6_score_comparison_buckets": ORACLES["C6_score_comparison"],
}
