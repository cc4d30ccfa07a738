import json
import os

import pytest
from pyspark.sql import functions as F

from riskframe.plans import run as plans
from riskframe.plans.model import Artifacts, TreeSettings
from riskframe.session import fresh_path, shared_folder
from riskframe.sources import views

DATA = "/root/testdata/sf0.001"


def test_from_raw_tables_to_reports(spark):
    tx, idn, path = views.transactions(spark, DATA), views.identities(spark, DATA), fresh_path(spark, "run")
    later = tx.drop("isFraud").withColumn("TransactionDT", F.col("TransactionDT") + 10 ** 7).limit(30)
    names = lambda: {n for n in os.listdir(f"{shared_folder(spark)}/riskframe") if n != "checkpoints"}
    before = names()
    done = plans.train_and_publish(tx, idn, path, TreeSettings(trees=3, depth=3, min_rows=5), unlabelled=(later, idn))
    left = {n.rsplit("-", 1)[0] for n in names() - before}
    assert left - {"run"} == {"encoded", "scored", "document"}  # what the result reads; all other tables are gone
    written = json.loads(spark.read.text(f"{path}/document").first()[0])
    assert list(written) == ["model", "dataset_facts", "split", "metrics", "review_queue", "review_policy",
                             "calibration_table", "top_feature_importance", "example_rows"]
    assert len(written["example_rows"]) == 10 and written["split"]["n_total"] == 1000
    assert written["dataset_facts"]["n_with_identity"] == written["dataset_facts"]["n_with_marker"]
    facts = written["dataset_facts"]
    assert (facts["n_labelled"], facts["n_unlabelled"]) == (1000, 30) and facts["unlabelled_from"] > 10 ** 7
    assert done.document.count() == 1

    parity = plans.serving_report(done).first()
    assert parity.n == done.artifacts.split.n_holdout and parity.release_gate.max_allowed_drop == 0.02

    rows = plans.verification_rows(tx, Artifacts.load(spark, f"{path}/model"))
    assert rows.count() == 20 and rows.where(F.col("calibrated_probability").isNull()).isEmpty()
    assert plans.check_rows(tx, done.artifacts).where("isFraud = 1").count() <= 50


def test_repeated_ids_are_refused(spark):
    tx = views.transactions(spark, DATA)
    with pytest.raises(ValueError):
        plans.clean_tables(tx.union(tx), views.identities(spark, DATA), fresh_path(spark, "merged"))
