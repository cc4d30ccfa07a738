"""Training, calibration and scoring with Spark ML."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.columns import review_flag
from riskframe.operators.encode import Encodings, apply_vocabulary, fit_dictionary, fit_encodings, load_encodings
from riskframe.operators.ranking import fit_review_policy
from riskframe.operators.split import TimeSplit, fit_time_split, positive_weight
from riskframe.plans.features import (
    align, build_features, default_id, feature_columns, finish, require_unique, row_features, split_valid, with_encodings,
    with_history,
)
from riskframe.schema import ID, IMPORTANCE_ROWS, LABEL, SEED, SHORT_LISTS
from riskframe.session import fresh_path, materialise, scratch, shared_folder
from riskframe.sources import versions

# Values that a declared short list may have; trees keep one histogram for each.
SHORT_VALUES = 63


@dataclass(frozen=True)
class TreeSettings:
    """``trees`` rounds at most; training ends when the validation loss has not fallen for ``patience`` rounds."""

    trees: int = 2000
    patience: int = 100
    depth: int = 6
    step: float = 0.05
    row_share: float = 0.8
    feature_share: str = "0.8"
    min_rows: int = 50
    seed: int = SEED


@dataclass
class Inputs:
    """How features become a vector.

    Trained columns with their types; a value below the minimum for missing numbers, and the numbers that get a null flag;
    text columns by the route their declaration gives them, whatever their size: short lists through an index, all others
    (``coded``: column → number of values) through code and count of the training vocabulary and a missing flag.
    """

    trained: dict[str, str]
    sentinels: dict[str, float]
    flagged: list[str]
    categories: list[str]
    coded: dict[str, int]

    def columns(self) -> list[str]:
        text = [f"{c}_{kind}" for c in self.coded for kind in ("code", "seen", "missing")]
        return [*self.sentinels, *[f"{c}_missing" for c in self.flagged], *[f"{c}_index" for c in self.categories], *text]

    def prepare(
        self, features: DataFrame, keep: Sequence[str], vocabulary: DataFrame, unique_id: str | None = None
    ) -> DataFrame:
        """``unique_id``, one of ``keep``, tells all rows apart; then large vocabularies do not move whole rows."""
        used = [*self.sentinels, *self.categories, *self.coded]
        narrow = align(features, {c: self.trained[c] for c in used}, keep)
        coded = apply_vocabulary(narrow, vocabulary, self.coded, unique_id=unique_id)
        # Flags and doubles come after the lookup, which may move the rows.
        numbers = [F.coalesce(F.col(c).cast("double"), F.lit(v)).alias(c) for c, v in self.sentinels.items()]
        flags = [F.col(c).isNull().cast("double").alias(f"{c}_missing") for c in self.flagged]
        found = [f"{c}_{kind}" for kind in ("code", "seen") for c in self.coded] + [f"{c}_missing" for c in self.coded]
        return coded.select(*keep, *numbers, *flags, *self.categories, *found)


def fit_inputs(train: DataFrame, categories: Sequence[str] | None = None) -> Inputs:
    """Read off the training rows, in one pass, what the model can take; see ``Inputs`` for the routes of text columns.

    A column without any value is left out. A short list that outgrows SHORT_VALUES is an error.
    """
    names = feature_columns(train)
    kinds = {f.name: f.dataType for f in train.schema.fields}
    numbers = [c for c in names if isinstance(kinds[c], T.NumericType)]
    texts = [c for c in names if isinstance(kinds[c], T.StringType)]
    declared = [c for c in texts if c in (SHORT_LISTS if categories is None else categories)]
    seen = train.agg(
        F.count("*").alias("n"),
        *[F.min(c).alias(f"min_{c}") for c in numbers],
        *[F.count(c).alias(f"has_{c}") for c in [*numbers, *texts]],
        *[F.count_distinct(c).alias(f"values_{c}") for c in declared],
    ).first().asDict()
    long = [c for c in declared if seen[f"values_{c}"] > SHORT_VALUES]
    if long:
        raise ValueError(f"declared as short lists, but with more than {SHORT_VALUES} values: {long}")
    used = [c for c in numbers if seen[f"has_{c}"]]
    return Inputs(
        trained={c: kinds[c].simpleString() for c in names},
        sentinels={c: float(seen[f"min_{c}"]) - 1.0 for c in used},
        flagged=[c for c in used if seen[f"has_{c}"] < seen["n"]],
        categories=[c for c in declared if seen[f"has_{c}"]],
        coded={c: 0 for c in texts if c not in declared and seen[f"has_{c}"]},
    )


def fit_vocabulary(train: DataFrame, inputs: Inputs, path: str) -> DataFrame:
    """Writes (column, value, code, seen) of the coded text columns, and notes in ``inputs`` how many values each has."""
    spark = train.sparkSession
    fitted = fit_dictionary(train, list(inputs.coded), counts=True) if inputs.coded else spark.createDataFrame([], _VOCABULARY)
    versions.replace_table(fitted, path)
    vocabulary = versions.read_table(spark, path, _VOCABULARY)
    sizes = {r["column"]: r["count"] for r in vocabulary.groupBy("column").count().collect()}
    inputs.coded = {c: sizes[c] for c in inputs.coded}
    return vocabulary


_VOCABULARY = "column string, value string, code bigint, seen bigint"


@dataclass
class Artifacts:
    inputs: Inputs
    trees: PipelineModel
    calibrator: IsotonicRegressionModel
    encodings: Encodings
    policy: dict
    split: TimeSplit
    path: str
    vocabulary: DataFrame
    best_iteration: int = 0

    def raw_scores(self, features: DataFrame, keep: Sequence[str] = (ID,), unique_ids: bool = False) -> DataFrame:
        """Uncalibrated probability of the positive class, as ``raw``."""
        kept = {f"_kept_{c}": F.col(c) for c in keep}
        by = f"_kept_{ID}" if unique_ids and ID in keep else None
        scored = self.trees.transform(self.inputs.prepare(features.withColumns(kept), list(kept), self.vocabulary, by))
        return scored.select(
            *[F.col(f"_kept_{c}").alias(c) for c in keep], vector_to_array("probability")[1].alias("raw")
        )

    def calibrate(self, raw: DataFrame) -> DataFrame:
        return self.calibrator.transform(raw)

    def score_features(
        self, features: DataFrame, keep: Sequence[str] = (ID,), threshold: float | None = None, unique_ids: bool = False
    ) -> DataFrame:
        """Calibrated ``score`` and ``review_flag``; the flag uses the unrounded score."""
        limit = self.policy["fitted_cutoff"] if threshold is None else threshold
        return self.calibrate(self.raw_scores(features, keep, unique_ids)).withColumn(
            "review_flag", review_flag(F.col("score"), limit)
        )

    def score(
        self, transactions: DataFrame, history: bool = True, threshold: float | None = None, unique_ids: bool = False
    ) -> DataFrame:
        """Score raw transactions: the same definition for a table and a stream.

        Rows that can't be scored are those of ``rejects``. ``history=False`` scores each row alone, so its result does
        not depend on the rows beside it. ``unique_ids`` (checked) keeps wide rows from being shuffled by key.
        """
        valid, _ = split_valid(default_id(transactions))
        if unique_ids:
            require_unique(valid)
        features = build_features(valid, self.encodings, history, unique_ids)
        scored = self.score_features(features, threshold=threshold, unique_ids=unique_ids)
        return scored.select(ID, F.round("score", 6).alias("calibrated_probability"), "review_flag")

    def input_table(self) -> DataFrame:
        """(column, route, n_values) of the text columns that the model takes."""
        indexed = self.trees.stages[0].labelsArray if self.inputs.categories else []
        rows = [(c, "short list", len(v)) for c, v in zip(self.inputs.categories, indexed)]
        rows += [(c, "code and count", n) for c, n in self.inputs.coded.items()]
        return SparkSession.active().createDataFrame(rows, "column string, route string, n_values bigint")

    def thresholds(self) -> DataFrame:
        """The calibration curve as (x, y) rows."""
        model, spark = self.calibrator, SparkSession.active()
        points = zip(model.boundaries.toArray().tolist(), model.predictions.toArray().tolist())
        return spark.createDataFrame(sorted(points), "x double, y double")

    def importance(self, top: int = IMPORTANCE_ROWS) -> DataFrame:
        """The features that reduce impurity most, with their share of the total."""
        gains = self.trees.stages[-1].featureImportances.toArray().tolist()
        return importance_table(dict(zip(self.inputs.columns(), gains)), top)

    def save(self, path: str | None = None) -> str:
        """Replace what is stored at ``path`` by these artifacts, all at once (see ``versions``)."""
        path, spark = path or self.path, SparkSession.active()
        version = versions.begin(path)
        self.trees.write().save(f"{version}/trees")
        self.calibrator.write().save(f"{version}/calibrator")
        settings = json.dumps({
            "inputs": vars(self.inputs), "policy": self.policy, "split": self.split.to_dict(),
            "best_iteration": self.best_iteration,
        })
        self.encodings.copy_to(f"{version}/maps")
        self.vocabulary.write.parquet(f"{version}/vocabulary")
        spark.createDataFrame([(settings,)], "value string").coalesce(1).write.text(f"{version}/settings")
        versions.publish(spark, path, version)
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Artifacts:
        stored = versions.current(spark, path)
        settings = json.loads(spark.read.text(f"{stored}/settings").first().value)
        return cls(
            Inputs(**settings["inputs"]),
            PipelineModel.load(f"{stored}/trees"),
            IsotonicRegressionModel.load(f"{stored}/calibrator"),
            load_encodings(spark, f"{stored}/maps"),
            settings["policy"],
            TimeSplit.from_dict(settings["split"]),
            path,
            spark.read.schema(_VOCABULARY).parquet(f"{stored}/vocabulary"),
            settings["best_iteration"],
        )


def importance_table(gains: Mapping[str, float], top: int = IMPORTANCE_ROWS) -> DataFrame:
    spark = SparkSession.active()
    ranked = sorted(gains.items(), key=lambda item: (-item[1], item[0]))[:top]
    total = sum(gains.values()) or 1.0
    rows = [(i, name, float(gain), round(gain / total, 4)) for i, (name, gain) in enumerate(ranked, start=1)]
    return spark.createDataFrame(rows, "rank int, feature string, gain double, gain_share double")


def rejects(transactions: DataFrame) -> DataFrame:
    """The rows that can't be scored, as they came, with ``reasons``."""
    return split_valid(default_id(transactions))[1]


def best_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """The round of the lowest loss, and whether ``patience`` rounds without a lower one have followed it.

    Rounds beyond those are not looked at, as training would have ended before them.
    """
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def first_trees(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The ensemble as it stood after ``rounds`` rounds: its own first trees with their weights, nothing is fitted."""
    if not 1 <= rounds <= model.getNumTrees:
        raise ValueError(f"{rounds} of {model.getNumTrees} trees")
    java, jvm = model._java_obj, SparkSession.active()._jvm
    kind = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    gateway = SparkSession.active().sparkContext._gateway
    trees, weights = gateway.new_array(kind, rounds), gateway.new_array(jvm.double, rounds)
    for i, (tree, weight) in enumerate(zip(list(java.trees())[:rounds], model.treeWeights)):
        trees[i], weights[i] = tree, float(weight)
    cut = jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        java.uid(), trees, weights, model.numFeatures, model.numClasses)
    return GBTClassificationModel(cut.copy(java.extractParamMap()))


def fit_trees(prepared: DataFrame, inputs: Inputs, settings: TreeSettings = TreeSettings()) -> tuple[PipelineModel, int]:
    """Boosted trees on the ``train`` rows and their number, which the ``val`` rows choose.

    The library's own early stop has no patience, so trees are grown in runs of doubled length until the best round is
    known; the last run is then cut to its first trees.  Positives weigh as much as negatives in
    total.  Category indexes come from the training rows only; unseen and missing values share one extra index.
    """
    spark = prepared.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_folder(spark)}/riskframe/checkpoints")
    weight = positive_weight(prepared.where(F.col("split") == "train")).first().positive_weight
    weighted = prepared.withColumn("weight", F.when(F.col(LABEL) == 1, weight).otherwise(1.0))
    train, val = (weighted.where(F.col("split") == s) for s in ("train", "val"))
    stages = []
    if inputs.categories:
        indexer = StringIndexer(
            inputCols=inputs.categories, outputCols=[f"{c}_index" for c in inputs.categories], handleInvalid="keep"
        )
        stages.append(indexer.fit(train))
    stages.append(VectorAssembler(inputCols=inputs.columns(), outputCol="features"))

    def grow(rounds: int) -> PipelineModel:
        trees = GBTClassifier(
            labelCol=LABEL, weightCol="weight", maxIter=rounds, maxDepth=settings.depth, stepSize=settings.step,
            subsamplingRate=settings.row_share, featureSubsetStrategy=settings.feature_share,
            minInstancesPerNode=settings.min_rows, seed=settings.seed, maxBins=SHORT_VALUES + 1,
            cacheNodeIds=True, checkpointInterval=10,
        )
        return Pipeline(stages=[*stages, trees]).fit(train)

    rounds = min(settings.trees, 2 * settings.patience)
    while True:
        model = grow(rounds)
        if val.isEmpty():
            return model, rounds
        assembled = PipelineModel(model.stages[:-1]).transform(val)
        best, known = best_round(model.stages[-1].evaluateEachIteration(assembled), settings.patience)
        if known or rounds == settings.trees:
            trees = first_trees(model.stages[-1], best)
            return PipelineModel([*model.stages[:-1], trees]), best
        rounds = min(settings.trees, 2 * rounds)


def fit_calibrator(raw: DataFrame, label: str = LABEL) -> IsotonicRegressionModel:
    """Isotonic curve from raw scores to observed rates; clips outside its range.

    Equal raw scores are merged first, which leaves the fit unchanged.
    """
    merged = raw.groupBy("raw").agg(
        F.avg(F.col(label).cast("double")).alias("rate"), F.count("*").cast("double").alias("weight")
    )
    return IsotonicRegression(
        featuresCol="raw", labelCol="rate", weightCol="weight", predictionCol="score"
    ).fit(merged)


def feature_table(transactions: DataFrame, split: TimeSplit, unique_ids: bool = False) -> DataFrame:
    """Features before encoding, with label and slice, written once by slice:
    fitting reads the train partition only."""
    rows = materialise(row_features(split.assign(transactions), carry=[LABEL, "split"]), "rows")
    rows = with_history(rows, unique_ids, n_rows=split.n_total)
    return materialise(rows, "features", partition_by=["split"])


def train(
    transactions: DataFrame,
    path: str | None = None,
    settings: TreeSettings = TreeSettings(),
    categories: Sequence[str] | None = None,
    unique_ids: bool = False,
) -> tuple[Artifacts, DataFrame]:
    """Fit everything; returns the artifacts and the encoded feature table.

    Maps, category indexes and trees see training rows, early stopping, the
    calibrator and the review policy validation rows; nothing sees the holdout.
    Intermediate tables other than the feature table are deleted at the end.
    """
    spark = transactions.sparkSession
    path = path or fresh_path(spark, "model")
    with scratch(spark, "encoded", "map"):
        if unique_ids:
            require_unique(transactions)
        split = fit_time_split(transactions)
        base = feature_table(transactions, split, unique_ids)
        encodings = fit_encodings(base.where(F.col("split") == "train"), f"{path}/maps")
        features = finish(with_encodings(base, encodings, unique_ids))
        features = materialise(features, "encoded", partition_by=["split"])

        in_train = features.where(F.col("split") == "train")
        inputs = fit_inputs(in_train, categories)
        vocabulary = fit_vocabulary(in_train, inputs, f"{path}/vocabulary")
        fitting = features.where(F.col("split") != "holdout")
        prepared = materialise(inputs.prepare(fitting, [ID, LABEL, "split"], vocabulary, ID if unique_ids else None), "prepared", partition_by=["split"])
        trees, best = fit_trees(prepared, inputs, settings)

        artifacts = Artifacts(inputs, trees, None, encodings, {}, split, path, vocabulary, best)
        raw = materialise(
            artifacts.raw_scores(features.where(F.col("split") == "val"), [ID, LABEL]), "validation"
        )
        artifacts.calibrator = fit_calibrator(raw)
        artifacts.policy = fit_review_policy(artifacts.calibrate(raw))
        return artifacts, features


def holdout_scores(artifacts: Artifacts, features: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Scored holdout rows, written once for all the reports that read them."""
    rows = features.where(F.col("split") == "holdout")
    extra = [ID, LABEL, *keep]
    return materialise(artifacts.score_features(rows, extra).drop("raw"), "scored")
