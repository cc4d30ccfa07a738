"""One registered query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions import columns as C
from riskframe.operators import encode, joins, metrics, monitor, quality, ranking
from riskframe.operators.history import time_since_previous
from riskframe.operators.positions import at_or_before, order_statistics
from riskframe.operators.split import fit_time_split, positive_weight, split_record, split_summary
from riskframe.plans import features as feat
from riskframe.plans import model as ml
from riskframe.plans import report
from riskframe.schema import (
    CATEGORICAL_COLUMNS, CHECK_POSITIVE_FLOOR, CHECK_ROWS, HISTORY_KEYS, ID, LABEL, POLICY_FRACTION, REQUIRED_FIELDS, TIME,
    numeric_family_columns, transaction_schema,
)
from riskframe.session import fresh_path, materialise, remove
from riskframe.sources import buckets, tables, views
from riskframe.streaming.drift import response_counts, start_counting, window_records
from riskframe.streaming.history import start_history, stream_history
from riskframe.streaming.route import read_routed
from riskframe.streaming.score import reject_stream, score_stream, start_routed_scoring, start_scoring

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Row counts the profile expects of the test tables at scale 0.01.
_EXPECTED = {"transactions": 10_000, "identities": 2_500, "orders": 15_000}


def query(name: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        return f

    return add


def sliced(rows: DataFrame) -> DataFrame:
    return fit_time_split(rows).assign(rows)


def stored_slices(spark: SparkSession, d: str) -> DataFrame:
    """Scored transactions written once by slice, for reports that read them often."""
    return materialise(sliced(views.scored(spark, d)), "slices", partition_by=["split"])


def holdout(spark: SparkSession, d: str) -> DataFrame:
    return sliced(views.scored(spark, d)).where(F.col("split") == "holdout")


def encoded_rows(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Row features with slice and label, and their training part."""
    rows = feat.row_features(sliced(views.transactions(spark, d)), carry=[LABEL, "split"])
    return rows, rows.where(F.col("split") == "train")


def as_double(*names: str) -> list:
    return [F.col(n).cast("double").alias(n) for n in names]


def rounded(*names: str, digits: int = 6) -> list:
    return [F.round(F.col(n).cast("double"), digits).alias(n) for n in names]


# --- sources and sinks --------------------------------------------------------

@query("A1_csv_scan")
def csv_scan(spark, d):
    path = fresh_path(spark, "csv")
    tables.write_csv(views.transactions(spark, d), path)
    return tables.read_csv(spark, path, transaction_schema())


@query("A2_csv_pruned_scan")
def csv_pruned(spark, d):
    path = fresh_path(spark, "csv")
    tables.write_csv(views.transactions(spark, d), path)
    return tables.read_csv(spark, path, transaction_schema(), [ID, LABEL, TIME])


@query("A1_csv_layouts")
def csv_layouts(spark, d):
    """Two files with the fields in other orders, one of them with a bad cell in each 31st row."""
    path = fresh_path(spark, "csv")
    tx = views.transactions(spark, d).select(ID, LABEL, TIME, "TransactionAmt", "C1", "ProductCD")
    tables.write_csv(tx.where(F.col(ID) % 2 == 0), f"{path}/a")
    odd = tx.where(F.col(ID) % 2 == 1).withColumn("C1", F.when(F.col(ID) % 31 == 0, "x1").otherwise(F.col("C1").cast("string")))
    tables.write_csv(odd.select("C1", "ProductCD", "TransactionAmt", TIME, LABEL, ID), f"{path}/b")
    rows = tables.read_csv(spark, f"{path}/*", transaction_schema(), bad_cells="bad")
    return rows.select(*tx.columns, F.concat_ws(",", "bad").alias("bad"))


def _broken_lines(tx: DataFrame) -> DataFrame:
    """CSV lines of transactions: each 31st with a cell too many, 37th a cell short, 41st with an open quote; each 43rd with a
    quoted cell that holds a comma and doubled quotes."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    product = F.when(F.col(ID) % 43 == 0, F.concat(F.lit('"'), text("ProductCD"), F.lit(', ""so""'), F.lit('"'))).otherwise(text("ProductCD"))
    product = F.when(F.col(ID) % 41 == 0, F.concat(F.lit('"'), product)).otherwise(product)
    line = F.concat_ws(",", text(ID), text(LABEL), text(TIME), F.col("card1").cast("string"), product)
    line = F.when(F.col(ID) % 31 == 0, F.concat(line, F.lit(",more"))).when(
        F.col(ID) % 37 == 0, F.concat_ws(",", text(ID), text(TIME))).otherwise(line)
    return tx.select(F.col(ID), line.alias("line"))


@query("A1_csv_malformed")
def csv_malformed(spark, d):
    """Good rows, and rejected lines as they are; together all lines that were written."""
    path = fresh_path(spark, "csv")
    lines = _broken_lines(views.transactions(spark, d))
    lines.select(F.col("line").alias(",".join([ID, LABEL, TIME, "card1", "ProductCD"]))).write.options(
        header=True, quote="\u0000", escapeQuotes=False, sep="\u0001").csv(path)
    rows = tables.read_csv(spark, path, transaction_schema(), malformed="line")
    return rows.select("line", ID, LABEL, TIME, "card1", "ProductCD")


@query("A3_parquet_scan")
def parquet_scan(spark, d):
    """All columns; the time as text, which both engines write alike."""
    rows = tables.read_parquet(spark, f"{d}/events.parquet")
    return rows.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query("A4_parquet_sink")
def parquet_sink(spark, d):
    path = fresh_path(spark, "merged")
    tables.write_parquet(joins.join_identity(views.transactions(spark, d), views.identities(spark, d)), path)
    return tables.read_parquet(spark, path)


@query("A5_fitted_maps_store")
def fitted_maps(spark, d):
    _, train = encoded_rows(spark, d)
    path = fresh_path(spark, "maps")
    encode.fit_encodings(train, path)
    loaded = encode.load_encodings(spark, path).long_table()
    return loaded.select("map", "key", "cnt", *rounded("mean_amt"))


@query("A6_json_report")
def json_report(spark, d):
    path = fresh_path(spark, "report")
    profile = quality.label_profile(views.transactions(spark, d))
    tables.write_report(profile, path)
    return tables.read_report(spark, path, profile.schema)


@query("A7_split_store")
def split_store(spark, d):
    path = fresh_path(spark, "split")
    tables.write_parquet(sliced(views.transactions(spark, d)).select(ID, "split"), path)
    return tables.read_parquet(spark, path)


@query("A7_split_store_buckets")
def split_store_buckets(spark, d):
    """The stored slices beside the rows they belong to, both in buckets by id."""
    rows = views.transactions(spark, d)
    stored = _bucketed(spark, sliced(rows).select(ID, "split"), "split")
    return _bucketed(spark, rows.select(ID, TIME), "tx").join(stored, ID)


@query("A9_strict_json")
def strict_json(spark, d):
    tx = views.transactions(spark, d)
    broken = tx.withColumn(
        "TransactionAmt",
        F.when(F.col(ID) % 31 == 0, float("nan")).when(F.col(ID) % 37 == 0, float("inf"))
        .otherwise(F.col("TransactionAmt")),
    )
    fields = [ID, TIME, "TransactionAmt", "ProductCD", "card1", "addr1", "P_emaildomain", "D1", "M1"]
    return broken.select(
        F.col(ID).alias("transaction_id"), tables.strict_json(broken, fields), LABEL
    )


@query("A9_strict_json_nested")
def strict_json_nested(spark, d):
    """Structs, arrays and maps with numbers that JSON does not have."""
    tx = views.transactions(spark, d)
    i, number = F.col(ID), F.floor("TransactionAmt").cast("double")
    broken = F.when(i % 31 == 0, float("nan")).when(i % 37 == 0, float("-inf")).otherwise(number)
    nested = tx.select(
        ID, F.array(number, broken).alias("amounts"), F.when(i % 5 != 0, F.struct(broken.alias("value"), F.col("ProductCD").alias("kind"))).alias("one"),
        F.array(F.struct(F.array(broken.cast("float"), F.lit(2.5).cast("float")).alias("deep"), i.alias("id"))).alias("many"),
        F.create_map(F.col("ProductCD"), broken).alias("by_kind"))
    return nested.select(F.col(ID).alias("transaction_id"), tables.strict_json(nested, ["amounts", "one", "many", "by_kind"]))


@query("A10_run_ledger")
def run_ledger(spark, d):
    path = fresh_path(spark, "ledger")
    rows = sliced(views.scored(spark, d))
    for run in ("train", "val", "holdout"):
        part = rows.where(F.col("split") == run)
        tables.append_run(part.agg(
            F.max(TIME).alias("ts"), F.lit(run).alias("run"), F.count("*").alias("n"),
            F.round(F.avg(F.col(LABEL).cast("double")), 6).alias("positive_rate"),
        ), path)
    ledger = spark.read.parquet(path)
    latest = tables.latest_run(ledger).select(F.col("ts").alias("last_ts"))
    return ledger.crossJoin(F.broadcast(latest)).select(
        "ts", "run", "n", "positive_rate", (F.col("ts") == F.col("last_ts")).alias("is_latest")
    )


def _evaluation(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = stored_slices(spark, d)
    policy = ranking.fit_review_policy(rows.where(F.col("split") == "val"))
    held = rows.where(F.col("split") == "holdout")
    record = metrics.evaluate(held, policy)
    exact = {"roc_auc", "pr_auc", "brier_score"}
    return rows, held, record.select(*[F.round(c, 6).alias(c) if c in exact else F.col(c) for c in record.columns])


@query("A11_report_document")
def report_document(spark, d):
    rows, held, record = _evaluation(spark, d)
    facts = report.table_facts({"transaction": views.transactions(spark, d), "identity": views.identities(spark, d)})
    examples = ranking.score_examples(
        held.withColumn("amt_log", C.log_amount(F.col("TransactionAmt")))
    )
    document = report.assemble(facts, split_summary_wide(rows), record, examples, "transaction risk")
    path = fresh_path(spark, "document")
    tables.write_report(document, path)
    return report.as_fields(tables.read_report(spark, path, document.schema))


def split_summary_wide(rows: DataFrame) -> DataFrame:
    count = lambda s: F.count(F.when(F.col("split") == s, 1)).alias(f"n_{s}")
    return rows.agg(F.count("*").alias("n_total"), count("train"), count("val"), count("holdout"))


# --- data quality -------------------------------------------------------------

@query("B1_table_profile")
def table_profile(spark, d):
    found = {
        "transactions": views.transactions(spark, d),
        "identities": views.identities(spark, d),
        "orders": views.order_transactions(spark, d),
    }
    return quality.profile_tables(found, _EXPECTED)


@query("B3_label_profile")
def label_profile(spark, d):
    return quality.label_profile(views.transactions(spark, d))


@query("B4_identity_coverage")
def identity_coverage(spark, d):
    return quality.identity_coverage(views.transactions(spark, d), views.identities(spark, d))


@query("B5_marker_rows")
def marker_rows(spark, d):
    tx = views.transactions(spark, d)
    merged = joins.join_identity(tx, views.identities(spark, d))
    return quality.marker_rows(merged).withColumn("source", F.lit("merged")).unionByName(
        quality.marker_rows(tx).withColumn("source", F.lit("unmerged"))
    )


@query("B6_missing_rate_by_family")
def missing_rate(spark, d):
    return quality.missing_rates_by_family(
        joins.join_identity(views.transactions(spark, d), views.identities(spark, d))
    )


@query("B8_selection_checks")
def selection_checks(spark, d):
    return quality.selection_checks(ranking.stratified_sample(holdout(spark, d)), CHECK_ROWS, CHECK_POSITIVE_FLOOR)


# --- joins --------------------------------------------------------------------

@query("C1_identity_join")
def identity_join(spark, d):
    return joins.join_identity(views.transactions(spark, d), views.identities(spark, d))


def _bucketed(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """Stored in buckets by id, and read back by its path."""
    path = fresh_path(spark, name)
    buckets.store_bucketed(rows, path, 8)
    return buckets.read_bucketed(spark, path)


@query("C1_identity_join_buckets")
def identity_join_buckets(spark, d):
    """The same of tables that lie in buckets by id: no row moves."""
    return joins.join_identity(_bucketed(spark, views.transactions(spark, d), "tx"), _bucketed(spark, views.identities(spark, d), "idn"))


@query("C2_frequency_lookup")
def frequency_lookup(spark, d):
    rows, train = encoded_rows(spark, d)
    maps = encode.fit_encodings(train)
    rows = encode.apply_encodings(rows, maps, maps=list(encode.FREQUENCY_KEYS))
    return rows.select(ID, *as_double(*encode.FREQUENCY_KEYS))


_GROUP_FEATURES = ["card1_mean_amt", "card1_addr1_count", "card1_addr1_mean_amt", "card1_P_emaildomain_count",
                   "card1_P_emaildomain_mean_amt"]


@query("C3_group_lookup")
def group_lookup(spark, d):
    rows, train = encoded_rows(spark, d)
    maps = encode.fit_encodings(train)
    rows = encode.apply_encodings(rows, maps, maps=list(encode.GROUP_KEYS))
    return rows.select(ID, *rounded(*_GROUP_FEATURES, digits=4))


@query("C5_calibration_curve")
def calibration_curve(spark, d):
    """The curve bends at each tenth of the score: its lowest score and rate there."""
    rows = views.scored(spark, d)
    curve = rows.groupBy(F.floor(F.col("score") * 10)).agg(
        F.min("score").alias("x"), (F.sum(LABEL) / F.count("*")).alias("y")
    )
    return joins.interpolate(rows.select(ID, "masked"), curve, "masked", "calibrated").select(
        ID, "masked", F.round("calibrated", 6).alias("calibrated")
    )


def _flagged(rows: DataFrame, score: str, present: str) -> DataFrame:
    return rows.where(F.col(present).isNotNull()).select(
        ID, F.col(score).alias("score"), C.review_flag(F.col(score), 0.1).alias("review_flag")
    )


@query("C6_score_comparison")
def score_comparison(spark, d):
    rows = views.scored(spark, d)
    compared = joins.compare_scores(_flagged(rows, "score", "addr1"), _flagged(rows, "masked", "P_emaildomain"))
    return compared.withColumn("mismatch", joins.is_mismatch())


@query("C6_score_comparison_buckets")
def score_comparison_buckets(spark, d):
    rows = views.scored(spark, d)
    left, right = (_bucketed(spark, _flagged(rows, *names), "scores") for names in (("score", "addr1"), ("masked", "P_emaildomain")))
    return joins.compare_scores(left, right).withColumn("mismatch", joins.is_mismatch())


# --- projections --------------------------------------------------------------

def row_query(name: str, build: Callable[[DataFrame], list]) -> None:
    QUERIES[name] = lambda spark, d: (lambda tx: tx.select(ID, *build(tx)))(views.transactions(spark, d))


@query("D1_drop_label")
def drop_label(spark, d):
    return feat.without_label(views.transactions(spark, d))


@query("D2_strict_cast")
def strict_cast(spark, d):
    tx = views.transactions(spark, d)
    text = tx.select(F.col(ID).cast("string").alias(ID), F.when(F.col(ID) % 29 != 0, F.col(TIME)).cast("string").alias(TIME))
    valid, _ = feat.split_valid(text, [ID, TIME])
    return valid.select(C.strict_long(F.col(ID)).alias(ID), C.strict_long(F.col(TIME)).alias(TIME))


row_query("D3_hour_of_day", lambda tx: [C.hour_of_day(F.col(TIME)).cast("double").alias("hour_of_day")])
row_query("D4_day_index", lambda tx: [C.day_index(F.col(TIME)).alias("day_index")])


def _amount_text():
    """Amounts as they come in text files: padded, wrong, NaN or missing."""
    amount, i = F.col("TransactionAmt"), F.col(ID)
    return (
        F.when(i % 11 == 0, "abc").when(i % 13 == 0, "NaN").when(i % 7 == 0, F.concat(F.lit(" "), amount.cast("string"), F.lit(" ")))
        .when(i % 19 == 0, "").otherwise(amount.cast("string"))
    )


row_query("D5_lenient_number", lambda tx: [C.lenient_double(_amount_text()).alias("amount")])
row_query("D6_clip_at_zero", lambda tx: [C.clip_at_zero(F.col("TransactionAmt") - 20).alias("clipped")])
row_query("D7_log_amount", lambda tx: [
    F.round(C.log_amount(F.col("TransactionAmt") - 20).cast("double"), 6).alias("amt_log")])
row_query("D8_numeric_families", lambda tx: [
    feat.as_float(tx, c).cast("double").alias(c) for c in numeric_family_columns(tx.columns)])
row_query("D9_flags", lambda tx: [C.flag_to_float(F.col(c)).cast("double").alias(c) for c in tx.columns if c == "M1"])
row_query("D12_missing_text", lambda tx: [C.key_text(F.col(c)).alias(f"{c}_key") for c in ("addr1", "P_emaildomain")])
row_query("D13_composite_key", lambda tx: [C.key_text(F.col("card1"), F.col("addr1")).alias("card1_addr1")])
row_query("D14_account", lambda tx: [
    C.start_day(C.day_index(F.col(TIME)), F.col("D1")).alias("start_day"),
    C.key_text(F.col("card1"), F.col("addr1"), C.start_day(C.day_index(F.col(TIME)), F.col("D1"))).alias("uid")])
row_query("D16_float_edge", lambda tx: [
    feat.as_float(tx, c).cast("double").alias(c) for c in ("TransactionAmt", "V1", "C1", "D1")])
row_query("D22_report_rounding", lambda tx: [C.report_round(F.col("V1") / 7, n).alias(f"v_{n}") for n in (3, 4, 6)])


@query("D10_categories")
def categories(spark, d):
    tx = views.transactions(spark, d)
    return feat.finish(feat.row_features(tx)).select(ID, *[c for c in CATEGORICAL_COLUMNS if c in tx.columns])


@query("D11_numeric_identity")
def numeric_identity(spark, d):
    merged = joins.join_identity(views.transactions(spark, d), views.identities(spark, d))
    return feat.row_features(merged).select(ID, *as_double("id_01"))


@query("D15_amount_ratio")
def amount_ratio(spark, d):
    rows, train = encoded_rows(spark, d)
    maps = encode.fit_encodings(train)
    keys, stats = encode.GROUP_KEYS["card1"]
    rows = encode.apply_group(rows, maps.groups["card1"], keys, "card1", stats, maps.n_rows["card1"])
    return rows.select(ID, F.round(C.ratio_to_mean(F.col("amt_log"), F.col("card1_mean_amt")).cast("double"), 4).alias("ratio"))


@query("D17_align_columns")
def align_columns(spark, d):
    trained = {"V1": "float", "amt_log": "float", "V2": "float", "R_emaildomain": "string", "hour_of_day": "float"}
    out = feat.align(feat.row_features(views.transactions(spark, d)), trained, keep=[ID])
    return out.select(ID, *as_double("V1"), *rounded("amt_log"), *as_double("V2"), "R_emaildomain", *as_double("hour_of_day"))


@query("D18_required_fields")
def required_fields(spark, d):
    tx = views.transactions(spark, d).withColumn(TIME, F.when(F.col(ID) % 29 != 0, F.col(TIME)))
    checked = feat.validate(tx, REQUIRED_FIELDS)
    return checked.select(ID, (F.size("reasons") == 0).alias("valid"), F.concat_ws(",", "reasons").alias("reasons"))


@query("D19_mask_history")
def masked_history(spark, d):
    rows = time_since_previous(views.transactions(spark, d))
    return feat.mask_history(rows).select(ID, "card1", *as_double(*HISTORY_KEYS))


@query("D21_review_flag")
def review_flags(spark, d):
    return views.scored(spark, d).select(
        ID, *[C.review_flag(F.col("score"), t).alias(n) for n, t in (("flag_default", 0.2), ("flag_strict", 0.37))]
    )


@query("D23_category_code")
def category_code(spark, d):
    rows = sliced(views.transactions(spark, d))
    codes = encode.fit_dictionary(rows.where(F.col("split") == "train"), ["ProductCD", "P_emaildomain", "card1"])
    codes = materialise(codes, "codes")
    for c in ("ProductCD", "P_emaildomain", "card1"):
        rows = encode.apply_dictionary(rows, codes, c, f"{c}_code")
    return rows.select(ID, "ProductCD_code", "P_emaildomain_code", "card1_code")


# --- fitted aggregates --------------------------------------------------------

@query("E1_frequency_maps")
def frequency_maps(spark, d):
    _, train = encoded_rows(spark, d)
    maps = encode.fit_encodings(train).long_table()
    return maps.where(F.col("map").isin(*encode.FREQUENCY_KEYS)).select("map", "key", "cnt")


@query("E2_group_counts")
def group_counts(spark, d):
    _, train = encoded_rows(spark, d)
    maps = encode.fit_encodings(train).long_table()
    counted = {f"group_{name}": name for name, (_, stats) in encode.GROUP_KEYS.items() if "count" in stats}
    return maps.where(F.col("map").isin(*counted)).select(F.substring("map", 7, 100).alias("map"), "key", "cnt")


@query("E3_group_means")
def group_means(spark, d):
    _, train = encoded_rows(spark, d)
    maps = encode.fit_encodings(train).long_table()
    return maps.where(F.col("map").startswith("group_")).select(F.substring("map", 7, 100).alias("map"), "key", *rounded("mean_amt"))


@query("E4_self_fit")
def self_fit(spark, d):
    built = feat.build_features(views.transactions(spark, d))
    return built.select(
        ID, "uid", *as_double("card1_count", "uid_count", "card1_addr1_count", "time_since_prev_card1_addr1"),
        *rounded("card1_mean_amt", "amt_to_card1_mean_ratio", digits=4),
    )


@query("E5_positive_weight")
def class_weight(spark, d):
    rows = sliced(views.transactions(spark, d))
    out = positive_weight(rows.where(F.col("split") == "train"))
    return out.select("n_positive", "n_negative", *rounded("positive_weight"))


@query("E6_split_summary")
def summarise_split(spark, d):
    return split_summary(sliced(views.transactions(spark, d)))


@query("E6_split_record")
def record_split(spark, d):
    tx = views.transactions(spark, d)
    split = fit_time_split(tx)
    out = split_record(split, split.assign(tx))
    floats = ["train_positive_rate", "val_positive_rate", "positive_weight"]
    return out.select(*[c for c in out.columns if c not in floats], *rounded(*floats))


@query("E7_percentile_cutoff")
def percentile_cutoff(spark, d):
    rows = sliced(views.scored(spark, d)).where(F.col("split") == "val")
    n, cutoff = ranking.interpolated_percentile(rows, "score", 0.98)
    return rows.agg(
        F.lit(n).cast("long").alias("n"), F.lit(round(cutoff, 6)).alias("cutoff"),
        F.count(F.when(F.col("score") >= cutoff, 1)).alias("n_at_or_above"),
    )


@query("E8_brier_score")
def brier(spark, d):
    return metrics.brier_score(views.scored(spark, d)).select(*rounded("brier_score"))


# --- order and position -------------------------------------------------------

@query("F1_time_since_previous")
def history(spark, d):
    return time_since_previous(views.transactions(spark, d)).select(ID, *as_double(*HISTORY_KEYS))


@query("F1_time_since_previous_ties")
def history_ties(spark, d):
    return time_since_previous(views.order_transactions(spark, d)).select(ID, *as_double(*HISTORY_KEYS))


@query("F1_time_since_previous_hot")
def history_hot(spark, d):
    """The same where most keys are cut into ranges."""
    return time_since_previous(views.transactions(spark, d), hot_rows=40).select(ID, *as_double(*HISTORY_KEYS))


# Rows of a file that a stream reads, about.
_FILE_ROWS = 500_000


def in_batches(spark: SparkSession, rows: DataFrame, order: list[str]) -> DataFrame:
    """A stream that delivers ``rows`` (with ``split``) in three micro-batches, slice by slice, which is in time order."""
    source = fresh_path(spark, "stream-in")
    files = -(-rows.count() // _FILE_ROWS) or 1
    for part in order:
        own = rows.where(F.col("split") == part).drop("split")
        (own.repartition(files) if files > 1 else own.coalesce(1)).write.mode("append").parquet(source)
        # A micro-batch is a number of files, so a slice that fills fewer gets empty ones.
        written = len(spark.read.schema(own.schema).parquet(source).inputFiles())
        for _ in range((order.index(part) + 1) * files - written):
            spark.createDataFrame([], own.schema).coalesce(1).write.mode("append").parquet(source)
    return spark.readStream.schema(rows.drop("split").schema).option("maxFilesPerTrigger", files).parquet(source)


@query("F1_time_since_previous_stream")
def history_stream(spark, d):
    """The same from keyed state, over three micro-batches."""
    stream = in_batches(spark, stored_slices(spark, d), ["train", "val", "holdout"])
    sink = fresh_path(spark, "history")
    start_history(stream_history(stream), sink, fresh_path(spark, "stream-state")).awaitTermination()
    return read_routed(spark, sink, "rows").select(ID, *as_double(*HISTORY_KEYS))


@query("F1_late_rows_stream")
def history_late_rows(spark, d):
    """With the slices in another order, the rows of the middle one come late and are turned away."""
    stream = in_batches(spark, stored_slices(spark, d), ["train", "holdout", "val"])
    sink = fresh_path(spark, "history")
    start_history(stream_history(stream), sink, fresh_path(spark, "stream-state")).awaitTermination()
    named = lambda name: read_routed(spark, sink, name).select(ID, TIME, F.lit(name).alias("routed_to"))
    return named("rows").unionByName(named("late"))


@query("F2_time_split")
def time_split(spark, d):
    return sliced(views.transactions(spark, d)).select(ID, TIME, "split")


@query("F2_time_split_ties")
def time_split_ties(spark, d):
    return sliced(views.order_transactions(spark, d)).select(ID, TIME, "split")


@query("F3_review_queue")
def review_queue(spark, d):
    return ranking.review_queue(holdout(spark, d))


@query("F4_calibration_table")
def calibration_bins(spark, d):
    return ranking.calibration_table(holdout(spark, d))


@query("F5_score_examples")
def score_examples(spark, d):
    rows = holdout(spark, d).withColumn("amt_log", C.log_amount(F.col("TransactionAmt")))
    return ranking.score_examples(rows)


@query("F6_stratified_sample")
def stratified(spark, d):
    return ranking.stratified_sample(holdout(spark, d)).select(ID, TIME, LABEL)


@query("F8_first_in_time")
def first_rows(spark, d):
    return ranking.first_in_time(holdout(spark, d)).select(ID, TIME, LABEL, "score")


@query("F9_top_overlap")
def overlap(spark, d):
    return ranking.top_overlap(holdout(spark, d), "score", "masked").select("k", "n_both", *rounded("overlap"))


@query("F10_nearest_rank")
def latency_ranks(spark, d):
    ranks = ranking.nearest_rank(_responses(holdout(spark, d)), "elapsed_ms", [0.5, 0.95])
    return holdout(spark, d).agg(
        F.count("*").alias("n"), F.lit(ranks[0.5]).cast("long").alias("p50_ms"), F.lit(ranks[0.95]).cast("long").alias("p95_ms")
    )


# --- evaluation and monitoring ------------------------------------------------

def _responses(rows: DataFrame, failing: bool = False, carry: tuple | list = ()) -> DataFrame:
    answer = F.when(F.col(ID) % 211 != 0, F.col("score")) if failing else F.col("score")
    return rows.select(
        ID, LABEL, answer.alias("calibrated_probability"), (F.lit(100) + F.col(ID) % 60).cast("double").alias("elapsed_ms"), *carry
    )


@query("H1_roc_auc")
def roc_auc(spark, d):
    return metrics.ranking_areas(views.scored(spark, d)).select("n", "n_positive", *rounded("roc_auc"))


@query("H2_average_precision")
def average_precision(spark, d):
    return metrics.ranking_areas(views.scored(spark, d)).select("n", "n_positive", *rounded("average_precision"))


@query("H3_evaluation_record")
def evaluation_record(spark, d):
    return report.as_fields(_evaluation(spark, d)[2])


@query("G7_review_policy")
def review_policy(spark, d):
    rows = sliced(views.scored(spark, d)).where(F.col("split") == "val")
    policy = ranking.fit_review_policy(rows)
    return rows.agg(
        F.lit(policy["top_fraction"]).alias("top_fraction"),
        F.lit(policy["fitted_cutoff"]).alias("fitted_cutoff"),
        F.lit(policy["fitted_on"]).alias("fitted_on"),
        F.lit(policy["n_validation"]).cast("long").alias("n_validation"),
    )


@query("H4_policy_metrics")
def policy_metrics(spark, d):
    rows = sliced(views.scored(spark, d))
    policy = ranking.fit_review_policy(rows.where(F.col("split") == "val"))
    return metrics.review_policy_metrics(rows.where(F.col("split") == "holdout"), policy)


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    rows = holdout(spark, d)
    return rows.select(ID, LABEL, F.col("score").alias("first_score"), F.col("masked").alias("second_score"))


@query("H5_score_shift")
def score_shift(spark, d):
    out = monitor.score_shift(materialise(_pairs(spark, d), "pairs"))
    return out.select("n", *rounded(*[c for c in out.columns if c != "n"]))


@query("H5_queue_pair")
def queue_pair(spark, d):
    return monitor.queue_pair(materialise(_pairs(spark, d), "pairs"))


@query("H6_release_gate")
def release_gate(spark, d):
    gate = monitor.release_gate(monitor.queue_pair(materialise(_pairs(spark, d), "pairs")))
    return gate.select("passes", "max_allowed_drop", *rounded("precision_drop", "recall_drop"))


@query("H7_drift_record")
def drift_record(spark, d):
    rows = stored_slices(spark, d)
    recorded = metrics.ranking_areas(rows.where(F.col("split") == "val")).first().roc_auc
    held = rows.where(F.col("split") == "holdout")
    records = [
        monitor.drift_record(_responses(held, failing), round(recorded, 6), release=name)
        for name, failing in (("answered", False), ("with errors", True))
    ]
    return records[0].unionByName(records[1])


@query("H7_drift_windows")
def drift_windows(spark, d):
    """A record for each closed week of a response log that comes in three micro-batches."""
    rows = _responses(stored_slices(spark, d), failing=True, carry=[TIME, "split"])
    stream = in_batches(spark, rows, ["train", "val", "holdout"])
    sink = fresh_path(spark, "drift")
    start_counting(response_counts(stream, 7 * 86400), sink, fresh_path(spark, "stream-state")).awaitTermination()
    return window_records(read_routed(spark, sink, "counts"), 0.75)


@query("H8_service_parity")
def service_parity(spark, d):
    rows = views.scored(spark, d)
    flagged = lambda score: rows.select(ID, score.alias("score"), C.review_flag(score, 0.2).alias("review_flag"))
    noise = F.when(F.col(ID) % 499 == 0, 0.001).otherwise(1e-9)
    out = monitor.service_parity(flagged(F.col("score")), flagged(F.col("score") + noise))
    return out.select(*[F.round(c, 6).alias(c) if c == "max_abs_diff" else F.col(c) for c in out.columns])


@query("G6_category_dictionary")
def category_dictionary(spark, d):
    rows = sliced(views.transactions(spark, d))
    return encode.fit_dictionary(rows.where(F.col("split") == "train"), ["ProductCD", "P_emaildomain", "M4", "card1"])


@query("flagship_queue_profile")
def queue_profile(spark, d):
    """Training-fitted features of the holdout, inside and outside the top 2 % by score."""
    tx = views.scored(spark, d)
    split = fit_time_split(tx)
    rows = materialise(feat.row_features(split.assign(tx), carry=[LABEL, "split", "score"]), "rows")
    built = materialise(feat.with_history(rows, n_rows=split.n_total), "features", partition_by=["split"])
    maps = encode.fit_encodings(built.where(F.col("split") == "train"))
    held = encode.apply_encodings(built.where(F.col("split") == "holdout"), maps)
    n, at = order_statistics(
        built.where(F.col("split") == "holdout"), "score", ID,
        lambda n: [ranking.top_size(n, POLICY_FRACTION) - 1], descending=True,
    )
    cut = at[ranking.top_size(n, POLICY_FRACTION) - 1]
    mean = lambda c: F.round(F.avg(F.col(c).cast("double")), 4).alias(f"mean_{c}")
    return held.groupBy(at_or_before("score", ID, cut, descending=True).alias("in_queue")).agg(
        F.count("*").alias("n_rows"), F.sum(F.col(LABEL).cast("long")).alias("n_positive"),
        F.round(F.avg(F.col(LABEL).cast("double")), 6).alias("precision"),
        *[mean(c) for c in ("card1_count", "uid_count", "card1_addr1_mean_amt", "amt_to_card1_mean_ratio",
                            "time_since_prev_card1", "time_since_prev_card1_addr1")],
    )


# --- model: trained once per session and state of the folder -------------------

# Short training for the registered queries; the defaults of TreeSettings are those of a real run.
_SETTINGS = ml.TreeSettings(trees=20, patience=20, depth=5, step=0.1)
_trained: dict[tuple, tuple[ml.Artifacts, DataFrame, DataFrame]] = {}


def trained(spark: SparkSession, d: str) -> tuple[ml.Artifacts, DataFrame, DataFrame]:
    """(artifacts, features, scored holdout rows) of the transactions in ``d``."""
    files = spark.read.parquet(f"{d}/events.parquet").select(
        "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    state = files.agg(F.sum(F.xxhash64(*files.columns).cast("decimal(38,0)"))).first()[0]
    key = (spark.sparkContext.applicationId, d, state)
    if key not in _trained:
        artifacts, features = ml.train(views.transactions(spark, d), settings=_SETTINGS, unique_ids=True)
        _trained[key] = artifacts, features, ml.holdout_scores(artifacts, features, ["ProductCD", "amt_log"])
    return _trained[key]


def forget_models() -> None:
    """Let the next query train again."""
    _trained.clear()


@query("G1_train_trees")
def train_trees(spark, d):
    """The holdout, and whether the trees rank it well: an area of 0.85 where it has 1,000 rows or more, see ``ranks_well``."""
    artifacts, _, scores = trained(spark, d)
    areas = metrics.ranking_areas(scores)
    return areas.select("n", "n_positive", (F.col("roc_auc") > 0.6).alias("better_than_chance"),
                        ((F.col("roc_auc") >= 0.85) | (F.col("n") < 1000)).alias("ranks_well"),
                        F.lit(1 <= artifacts.best_iteration <= _SETTINGS.trees).alias("rounds_within_limit"))


@query("G1_model_inputs")
def model_inputs(spark, d):
    return trained(spark, d)[0].input_table()


@query("G2_raw_scores")
def raw_scores(spark, d):
    artifacts, features, _ = trained(spark, d)
    return artifacts.raw_scores(features, [ID, LABEL]).select(ID, LABEL, F.col("raw").between(0, 1).alias("in_range"))


@query("G3_isotonic_fit")
def isotonic_fit(spark, d):
    """The fitted calibrator against the same curve drawn from its thresholds."""
    artifacts, features, _ = trained(spark, d)
    raw = artifacts.calibrate(artifacts.raw_scores(features))
    drawn = joins.interpolate(raw, artifacts.thresholds(), "raw", "interpolated")
    apart = F.abs(F.col("score") - F.col("interpolated")) > 1e-12
    return drawn.agg(F.count("*").alias("n"), F.count(F.when(F.coalesce(apart, F.lit(True)), 1)).alias("n_apart"))


@query("G4_calibrated_scores")
def calibrated_scores(spark, d):
    artifacts, _, scores = trained(spark, d)
    flag = F.col("score") >= F.lit(artifacts.policy["fitted_cutoff"])
    return scores.select(ID, LABEL, F.col("score").between(0, 1).alias("in_range"), (F.col("review_flag") == flag).alias("flag_fits"))


@query("G5_calibrator_thresholds")
def calibrator_thresholds(spark, d):
    """One row on the whole curve; its points are at most as many as distinct validation scores."""
    steps = joins.curve_steps(trained(spark, d)[0].thresholds())
    return steps.agg(
        F.coalesce(F.min(F.col("dx") > 0), F.lit(True)).alias("x_rises"), F.coalesce(F.min(F.col("dy") >= 0), F.lit(True)).alias("y_never_falls"),
        F.min(F.col("y").between(0, 1)).alias("y_in_range"))


@query("F7_feature_importance")
def feature_importance(spark, d):
    rows = trained(spark, d)[0].importance()
    return rows.select(F.col("rank"), F.col("gain_share").between(0, 1).alias("share_in_range"), (F.col("gain") >= 0).alias("gain_counts"))


@query("A8_model_store")
def model_store(spark, d):
    """Scores before saving against scores after saving, loading, saving elsewhere and loading without the first copy."""
    artifacts, features, _ = trained(spark, d)
    first = artifacts.save(fresh_path(spark, "artifacts"))
    second = ml.Artifacts.load(spark, first).save(fresh_path(spark, "artifacts"))
    remove(spark, first)
    again = ml.Artifacts.load(spark, second)
    summary = joins.comparison_summary(joins.compare_scores(artifacts.score_features(features), again.score_features(features)))
    return summary.select("n_ids", "n_mismatches")


@query("G8_batch_scores")
def batch_scores(spark, d):
    scored = trained(spark, d)[0].score(views.transactions(spark, d), unique_ids=True)
    return scored.select(ID, F.col("calibrated_probability").between(0, 1).alias("in_range"), F.col("review_flag").isNotNull().alias("has_flag"))


def streamed(spark: SparkSession, d: str) -> DataFrame:
    """The transactions as the scoring stream writes them."""
    artifacts, _, _ = trained(spark, d)
    source, sink = fresh_path(spark, "stream-in"), fresh_path(spark, "stream-out")
    tx = views.transactions(spark, d).drop(LABEL)
    tx.write.parquet(source)
    stream = spark.readStream.schema(tx.schema).parquet(source)
    start_scoring(score_stream(stream, artifacts), sink, fresh_path(spark, "stream-state")).awaitTermination()
    return spark.read.parquet(sink)


@query("G9_stream_scores")
def stream_scores(spark, d):
    """The stream against the same rows scored as a table, each alone."""
    batch = trained(spark, d)[0].score(views.transactions(spark, d), history=False)
    named = lambda df: df.withColumnRenamed("calibrated_probability", "score")
    summary = joins.comparison_summary(joins.compare_scores(named(batch), named(streamed(spark, d))))
    return summary.select("n_ids", "n_mismatches")


@query("G9_stream_rejects")
def stream_rejects(spark, d):
    """What the scoring stream turns away, with the reasons."""
    source, sink = fresh_path(spark, "stream-in"), fresh_path(spark, "stream-out")
    tx = views.transactions(spark, d).drop(LABEL)
    tx.write.parquet(source)
    stream = spark.readStream.schema(tx.schema).parquet(source)
    start_scoring(reject_stream(stream), sink, fresh_path(spark, "stream-state")).awaitTermination()
    return spark.read.parquet(sink).select(ID, F.concat_ws(",", "reasons").alias("reasons"))


@query("G9_stream_routed")
def stream_routed(spark, d):
    """Where each row of three micro-batches went, and whether its score is that of the row scored in a table."""
    artifacts, _, _ = trained(spark, d)
    stream = in_batches(spark, sliced(views.transactions(spark, d)).drop(LABEL), ["train", "val", "holdout"])
    sink = fresh_path(spark, "routed")
    start_routed_scoring(stream, artifacts, sink, fresh_path(spark, "stream-state")).awaitTermination()
    alone = artifacts.score(views.transactions(spark, d), history=False).select(ID, F.col("calibrated_probability").alias("alone"))
    scored = read_routed(spark, sink, "scored").join(alone, ID, "left")
    same = F.coalesce(F.col("alone") == F.col("calibrated_probability"), F.lit(False))
    rejected = read_routed(spark, sink, "rejected")
    return scored.select(ID, F.lit("scored").alias("routed_to"), F.lit("").alias("reasons"), same.alias("as_in_table")).unionByName(
        rejected.select(ID, F.lit("rejected").alias("routed_to"), F.concat_ws(",", "reasons").alias("reasons"), F.lit(True).alias("as_in_table")))


@query("G8_batch_rejects")
def batch_rejects(spark, d):
    return ml.rejects(views.transactions(spark, d)).select(ID, F.concat_ws(",", "reasons").alias("reasons"))
