"""From raw tables to published reports, in the order they depend on each other."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import log_amount
from riskframe.operators import joins, metrics, monitor, quality, ranking
from riskframe.operators.split import split_record
from riskframe.plans import model as ml
from riskframe.plans import report
from riskframe.plans.features import mask_history
from riskframe.schema import AMOUNT, ID, LABEL, TIME
from riskframe.session import materialise, scratch
from riskframe.sources import versions
from riskframe.sources.tables import write_report


@dataclass
class Run:
    artifacts: ml.Artifacts
    features: DataFrame
    scores: DataFrame
    document: DataFrame


def clean_tables(transactions: DataFrame, identity: DataFrame, path: str) -> DataFrame:
    """Join identity on, refuse repeated ids, and keep the merged table at ``path``."""
    if not joins.duplicate_keys(transactions).isEmpty():
        raise ValueError(f"transaction table repeats {ID}")
    merged = joins.join_identity(transactions, identity, unique_identity=True)
    return versions.replace_table(merged, path)


def time_range(rows: DataFrame, name: str) -> DataFrame:
    """One row: how many there are, and the first and last time."""
    return rows.agg(F.count("*").alias(f"n_{name}"), F.min(TIME).alias(f"{name}_from"), F.max(TIME).alias(f"{name}_to"))


def train_and_publish(
    transactions: DataFrame, identity: DataFrame, path: str, settings: ml.TreeSettings = ml.TreeSettings(),
    unlabelled: tuple[DataFrame, DataFrame] | None = None,
) -> Run:
    """Train on the merged table, evaluate the holdout, write artifacts and document.

    An ``unlabelled`` pair of tables is merged beside it; the document states the rows and times of both.
    Intermediate tables go, but for the features, scores and document of the result.
    """
    with scratch(transactions.sparkSession, "encoded", "map", "scored", "document"):
        merged = clean_tables(transactions, identity, f"{path}/merged")
        spans = [time_range(merged, "labelled")]
        if unlabelled is not None:
            spans.append(time_range(clean_tables(*unlabelled, f"{path}/merged_unlabelled"), "unlabelled"))
        artifacts, features = ml.train(merged, f"{path}/model", settings, unique_ids=True)
        artifacts.save()
        scores = ml.holdout_scores(artifacts, features, ["ProductCD", "amt_log"])
        record = metrics.evaluate(scores, artifacts.policy, artifacts.importance())

        facts = metrics.cross([
            quality.label_profile(merged),
            quality.identity_coverage(transactions, identity).select("n_with_identity", "pct_with_identity"),
            quality.marker_rows(merged).select("n_with_marker"),
            metrics.rows_as_array(quality.missing_rates_by_family(merged), "family", "missing_rates"),
            *spans,
        ]).withColumn("n_columns", F.lit(len(merged.columns)))
        split = split_record(artifacts.split, artifacts.split.assign(merged.select(ID, "TransactionDT", LABEL)))
        split = split.withColumns({"trees": F.lit(artifacts.best_iteration), "seed": F.lit(settings.seed)})
        document = report.assemble(facts, split, record, ranking.score_examples(scores))
        document = materialise(document, "document")
        write_report(document, f"{path}/document")
        return Run(artifacts, features, scores, document)


def serving_report(run: Run, strict: bool = False) -> DataFrame:
    """What the holdout scores lose when history is unknown, and the release gate."""
    held = run.features.where(F.col("split") == "holdout")
    masked = run.artifacts.score_features(mask_history(held))
    pairs = monitor.pair_scores(run.scores, run.scores, masked.select(ID, "score"))
    queues = materialise(monitor.queue_pair(pairs), "queues")
    gate = monitor.release_gate(queues)
    if strict:
        monitor.require_gate(gate)
    return metrics.cross([
        monitor.score_shift(pairs),
        metrics.rows_as_array(queues, "top_fraction", "review_queues"),
        gate.select(F.struct(*gate.columns).alias("release_gate")),
    ])


def check_rows(transactions: DataFrame, artifacts: ml.Artifacts) -> DataFrame:
    """The fixed rows a live service is asked about: a stratified holdout sample."""
    held = artifacts.split.assign(transactions).where(F.col("split") == "holdout").drop("split")
    return ranking.stratified_sample(held)


def verification_rows(transactions: DataFrame, artifacts: ml.Artifacts) -> DataFrame:
    """The first holdout rows with the score each gets alone."""
    held = artifacts.split.assign(transactions).where(F.col("split") == "holdout").drop("split")
    first = ranking.first_in_time(held)
    scored = artifacts.score(first.drop(LABEL), history=False)
    return first.withColumn("amt_log", log_amount(F.col(AMOUNT))).join(F.broadcast(scored), ID)
