import pytest
from pyspark.sql import functions as F
from rows import frame, row

from riskframe.operators import joins, metrics
from riskframe.plans import model as ml
from riskframe.plans.features import row_features, split_valid
from riskframe.plans.queries import streamed, trained
from riskframe.sources import views

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return trained(spark, DATA)


def test_quality_floor(model):
    artifacts, _, scores = model
    assert metrics.ranking_areas(scores).first().roc_auc >= 0.85
    assert scores.count() == artifacts.split.n_holdout


def test_first_trees_equal_a_shorter_fit(spark, monkeypatch):
    tx = views.transactions(spark, "/root/testdata/sf0.001")
    fits = []
    fit = ml.GBTClassifier._fit
    monkeypatch.setattr(ml.GBTClassifier, "_fit", lambda self, rows: fits.append(self.getMaxIter()) or fit(self, rows))
    whole, features = ml.train(tx, settings=ml.TreeSettings(trees=6, patience=6, depth=3))
    assert fits == [6]  # one run, and no second one up to the best round
    short, _ = ml.train(tx, settings=ml.TreeSettings(trees=4, patience=6, depth=3))
    model = whole.trees.stages[-1]
    for k in range(1, min(model.getNumTrees, short.best_iteration) + 1):
        a, b = ml.first_trees(model, k), ml.first_trees(short.trees.stages[-1], k)
        assert a.toDebugString.split("\n", 1)[1] == b.toDebugString.split("\n", 1)[1] and a.treeWeights == b.treeWeights
    cut = ml.first_trees(model, 1)
    assert cut.getNumTrees == 1 and cut.numFeatures == model.numFeatures and cut.getStepSize() == model.getStepSize()
    with pytest.raises(ValueError):
        ml.first_trees(model, 0)


def test_maps_and_categories_know_training_rows_only(spark):
    tx = views.transactions(spark, "/root/testdata/sf0.001")
    last = tx.agg(F.max("TransactionDT")).first()[0]
    late = tx.withColumns({
        "card1": F.when(F.col("TransactionDT") > last - 1000, 777_777).otherwise(F.col("card1")),
        "ProductCD": F.when(F.col("TransactionDT") > last - 1000, "late").otherwise(F.col("ProductCD")),
    })
    artifacts, features = ml.train(late, settings=ml.TreeSettings(trees=2, depth=2))
    assert artifacts.encodings.counts["card1_count"].where("card1 = 777777").isEmpty()
    labels = artifacts.trees.stages[0].labelsArray
    assert all("late" not in values for values in labels)
    assert artifacts.policy["fitted_on"] == "validation" and artifacts.policy["n_validation"] == artifacts.split.n_val
    assert features.where("card1 = '777777'").agg(F.max("card1_count")).first()[0] == 0.0


def test_threshold_and_flag(model, spark):
    artifacts, _, _ = model
    tx = views.transactions(spark, DATA)
    everything = artifacts.score(tx, history=False, threshold=0.0)
    assert everything.where("NOT review_flag").isEmpty()
    assert everything.columns == ["TransactionID", "calibrated_probability", "review_flag"]


def test_alone_in_a_batch_and_in_a_stream_are_the_same(model, spark):
    artifacts, _, _ = model
    tx, _ = split_valid(views.transactions(spark, DATA))
    batch = artifacts.score(tx, history=False).withColumnRenamed("calibrated_probability", "score")
    stream = streamed(spark, DATA).withColumnRenamed("calibrated_probability", "score")
    summary = joins.comparison_summary(joins.compare_scores(batch, stream)).first()
    assert summary.n_mismatches == 0 and summary.n_ids > 9000
    few = tx.where("TransactionID IN (5, 77, 4001)")
    alone = artifacts.score(few, history=False).withColumnRenamed("calibrated_probability", "score")
    same = batch.join(few.select("TransactionID"), "TransactionID", "left_semi")
    assert joins.comparison_summary(joins.compare_scores(alone, same)).first().n_mismatches == 0
    bare = few.select("TransactionDT", "TransactionAmt", "card1").limit(1)
    assert artifacts.score(bare, history=False).first().TransactionID == 0


def test_routes_follow_the_declaration_not_the_size(spark):
    rows = []
    for i in range(400):
        rows.append(row(TransactionID=i, TransactionDT=1000 + i * 50, isFraud=int(i % 9 == 0)) | {
            "R_emaildomain": f"mail{i % 60}", "DeviceType": "mobile" if i % 2 else None})
    base = frame(spark, *rows)
    extra = spark.createDataFrame([(r["TransactionID"], r["R_emaildomain"], r["DeviceType"]) for r in rows],
                                  "TransactionID bigint, R_emaildomain string, DeviceType string")
    artifacts, _ = ml.train(base.join(extra, "TransactionID"), settings=ml.TreeSettings(trees=2, depth=2, min_rows=5))
    columns = artifacts.inputs.columns()
    assert {"R_emaildomain_code", "R_emaildomain_seen", "R_emaildomain_missing", "DeviceType_index", "uid_code"} <= set(columns)
    assert artifacts.inputs.coded["R_emaildomain"] == 60
    kept = artifacts.inputs.prepare(spark.createDataFrame([(1, None, None), (2, "mail3", "mobile"), (3, "new", "tv")],
                                    "TransactionID bigint, R_emaildomain string, DeviceType string"), ["TransactionID"], artifacts.vocabulary)
    got = {r.TransactionID: r for r in kept.collect()}
    assert (got[1].R_emaildomain_code, got[1].R_emaildomain_missing) == (-1.0, 1.0)
    assert got[2].R_emaildomain_code >= 0 and got[2].R_emaildomain_seen > 0 and got[3].R_emaildomain_seen == 0.0


def test_short_lists_that_grow_are_an_error(spark):
    rows = [row(TransactionID=i, ProductCD=f"p{i}") for i in range(100)]
    with pytest.raises(ValueError):
        ml.fit_inputs(row_features(frame(spark, *rows)))


def test_patience():
    losses = [5, 4, 3, 3, 3, 2.5, 2.6, 2.7, 2.8, 1.0]
    assert ml.best_round(losses, 2) == (3, True)
    assert ml.best_round(losses, 3) == (6, True)
    assert ml.best_round(losses, 50) == (10, False)


def test_ids_promised_unique_are_checked(spark):
    tx = views.transactions(spark, "/root/testdata/sf0.001")
    with pytest.raises(ValueError):
        ml.train(tx.union(tx), unique_ids=True)


def test_nothing_is_lost_between_scores_and_rejects(model, spark):
    tx = views.transactions(spark, DATA)
    scored, turned = model[0].score(tx, history=False), ml.rejects(tx)
    assert scored.count() + turned.count() == tx.count() and turned.where("size(reasons) = 0").isEmpty()


def test_importance_shares(spark):
    rows = ml.importance_table({"a": 1.0, "b": 3.0, "c": 0.0}, 2).collect()
    assert [(r.feature, r.gain_share) for r in rows] == [("b", 0.75), ("a", 0.25)]
    assert ml.importance_table({"a": 0.0}).first().gain_share == 0.0
