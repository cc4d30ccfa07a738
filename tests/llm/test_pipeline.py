"""Each stage of the pipeline against brute force on what the stage before kept."""

import re

import corpus_pipeline
import pytest

from riskframe.llm import language, toxicity
from riskframe.llm.vocabulary import vocabulary

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """The rows after each stage."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, out[-1], SMALL).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_all_but_the_last_stage_keep_the_columns(kept):
    assert all(df.dtypes == kept[0].dtypes for df in kept[1:-1])
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "language_id", "exact_dedup", "simhash_near_dedup", "best_fit_packing"]


def test_models_decide_the_first_two(spark, kept):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    told = toxicity.toxicity(kept[0], labels).filter("predicted = 0").select("doc_id")
    assert sorted(told.collect()) == sorted(kept[1].select("doc_id").collect())
    told = language.identify(kept[1], vocabulary(spark, "piece_bpe_32k.model"))
    told = told.filter(f"lang_pred <> 'und' and score >= {language.KEPT_SHARE}").select("doc_id")
    assert sorted(told.collect()) == sorted(kept[2].select("doc_id").collect())


def test_one_row_of_each_group_stays(kept):
    from test_dedup import print_by_force, roots_by_force

    groups = {}
    for r in kept[2].collect():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r.text), []).append((-len(r.text), r.doc_id))
    assert sorted(r.doc_id for r in kept[3].collect()) == sorted(min(g)[1] for g in groups.values())
    prints = {r.doc_id: print_by_force(r.text) for r in kept[3].collect()}
    root, least = roots_by_force(sorted(set(prints.values()))), {}
    for doc_id, p in prints.items():
        least[root[p]] = min(doc_id, least.get(root[p], doc_id))
    assert sorted(r.doc_id for r in kept[4].collect()) == sorted(least.values())


def test_packed_rows_are_the_kept_documents(spark, kept):
    rows = kept[5].collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in kept[4].collect()}
    run = corpus_pipeline.run(spark, SMALL)
    facts = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(run.select(facts).collect()) == sorted(kept[5].select(facts).collect())
    assert {r.sequence_id for r in run.collect()} == {r.sequence_id for r in rows}


def test_repeated_null_and_empty_rows(spark):
    rows = [(1, "the same words", "en", "s", 1), (1, "the same words", "en", "s", 1), (2, "the  same words", None, None, None),
            (None, "the same words", "en", "s", 1), (3, None, None, None, None), (4, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{SMALL}/documents.parquet").schema)
    for _, stage in corpus_pipeline.STAGES[2:4]:
        docs = stage(spark, docs, SMALL)
    assert sorted(r.doc_id for r in docs.collect()) == [2, 3]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), SMALL).count() == 0


def test_columns_with_names_of_ours(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    docs = docs.selectExpr("*", "true as __keep", "1 as __id", "2 as __hash", "0.5D as score", "'x' as fp", "3 as row_id", "4 as _id")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SMALL)
        assert after.dtypes == docs.dtypes and 0 < after.count() <= 60
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() >= 60


def test_whole_pipeline_on_empty_tables(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path))
    assert rows.count() == 0 and {"doc_id", "piece", "sequence_id", "offset"} <= set(rows.columns)
