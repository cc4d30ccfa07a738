"""Segmentation-marginalised language ID: sums over all cuts, held-out accuracy, odd rows."""

import math
import random

import numpy as np
import public_tokenizers
import pytest

from riskframe.llm import language, queries
from riskframe.llm.common import bounded_sample

SMALL = "/root/testdata/sf0.01"
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def cuts(word, pieces):
    """All ways to cut a word; a character that is no piece is the unknown piece."""
    if not word:
        return [[]]
    out = []
    for i in range(1, len(word) + 1):
        p = pieces.get(word[:i], len(pieces) if i == 1 else None)
        if p is not None:
            out += [[p, *rest] for rest in cuts(word[i:], pieces)]
    return out


@pytest.mark.parametrize("long", [50, 3])
def test_forward_pass_and_expected_counts_equal_all_cuts(long, monkeypatch):
    monkeypatch.setattr(language.Lattice, "LONG", long)
    rng = random.Random(1)
    pieces = {p: i for i, p in enumerate(["a", "b", "ab", "aba", "ba", "bb", "abab", "▁", "▁a", "▁ab", "c"])}
    words = ["▁" + "".join(rng.choices("abcx", k=rng.randint(1, 7))) for _ in range(40)]
    log_p = np.log(np.random.default_rng(2).dirichlet(np.ones(12), 3))
    prefixes, times = language.Prefixes(pieces), np.arange(1.0, 41.0)
    sums, counts = np.zeros((40, 3)), np.zeros(12)
    for places, lattice in language.lattices(words, prefixes, 11):
        sums[places] = lattice.log_words(log_p)
        counts += lattice.expected(log_p[0], times[places])
    want = np.zeros(12)
    for w, word in enumerate(words):
        all_cuts = cuts(word, pieces)
        for k in range(3):
            assert sums[w, k] == pytest.approx(math.log(sum(math.exp(log_p[k, c].sum()) for c in all_cuts)))
        share = np.array([math.exp(log_p[0, c].sum()) for c in all_cuts])
        for c, s in zip(all_cuts, share / share.sum()):
            np.add.at(want, c, s * times[w])
    assert counts == pytest.approx(want)


def test_held_out_accuracy_and_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = queries.QUERIES["op4_language_id"](spark, SMALL)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(200).select("doc_id", "text", "lang")
    words = "thing ".encode().decode()
    odd = [(10001, None, "en"), (10002, "", "en"), (10003, "12 -- ...", None), (None, "the and of", "en"), (10004, "x" * 5000, None),
           (10004, "x" * 5000, None), (10005, words * 20000, None), (10006, "² Ⅷ", "en"), (10007, "中文", None)]
    rows = language.identify(docs.union(spark.createDataFrame(odd, docs.schema)).selectExpr("*", "1 as score"), PIECES).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == 209
    assert [by[i].lang_pred for i in (10001, 10002, 10003)] == ["und"] * 3 and by[10006].lang_pred == "und"
    assert by[10004].lang_pred != "und" and by[10005].lang_pred != "und" and by[None].held_out is False
    kept = language.keep_identified(docs.union(spark.createDataFrame(odd, docs.schema)), PIECES)
    assert kept.columns == docs.columns and 10002 not in {r.doc_id for r in kept.collect()}


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert language.identify(empty, PIECES).count() == 0
    alone = spark.createDataFrame([(1, "word", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in language.identify(alone, PIECES).collect()] == [(1, False, "und", 0.0)]


def test_every_language_is_learned(spark, monkeypatch):
    """More languages than a list on the driver once held, and one that has very long documents only."""
    rng = random.Random(3)
    names = [f"l{i:03d}" for i in range(230)]
    own = {n: ["".join(rng.choices("abcdefghijklmnoprstuvz", k=7)) for _ in range(6)] for n in names}
    rows = [(8 * i + j, " ".join(rng.choices(own[n], k=12)), n) for i, n in enumerate(names) for j in range(8)]
    rows += [(9000 + j, "xylo quux wyrm " * 7000, "long") for j in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs, PIECES)
    assert model.languages == ["l%03d" % i for i in range(230)] + ["long"]
    told = language.Scorer(model)([" ".join(own["l007"]), "quux wyrm xylo"])
    assert [t[0] for t in told] == ["l007", "long"]
    monkeypatch.setattr(language, "MOST_LANGUAGES", 200)
    with pytest.raises(ValueError, match="231 languages"):
        language.train(docs, PIECES)


def test_repeated_rows_do_not_lengthen_a_sample(spark):
    rows = [(1, "same", "en")] * 500 + [(i, f"w{i}", "de") for i in range(500)] + [(2, "no", None)]
    got = bounded_sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 10, per="lang").collect()
    assert sum(r.lang == "en" for r in got) <= 20 and 0 < sum(r.lang == "de" for r in got) <= 20
    assert sum(r.lang is None for r in got) == 1
