"""The convolutional classifier: gradients, held-out quality, odd rows."""

import random

import numpy as np
import pytest

from riskframe.llm import queries, toxicity

SMALL = "/root/testdata/sf0.01"


def area(score, label):
    order = np.argsort(np.argsort(score)) + 1
    n = label.sum()
    return (order[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


def test_step_follows_the_numeric_gradient():
    s = toxicity.Settings(buckets=40, size=3, widths=(1, 2), filters=2, step=1.0)
    net = toxicity._Net(s, np.random.default_rng(1))
    net.bias += 0.1  # away from the bend at 0
    rng = np.random.default_rng(2)
    docs = [rng.integers(1, 40, (n, toxicity.ROWS)) for n in (3, 1, 6, 0)]
    y, w = np.array([1.0, 0, 1, 0]), np.array([1.0, 2, 0.5, 1])

    def loss():
        p = toxicity._sigmoid(net.forward(docs)[-1])
        return float((w * -(y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / 4)

    got = {}
    net._adagrad = lambda name, value, gradient, rows=None: got.update({name: (gradient.copy(), rows)})
    net.learn(docs, y, w)
    for name, value in (("filter1", net.filters[1]), ("out", net.out), ("bias", net.bias)):
        for at in np.ndindex(value.shape):
            old = value[at]
            value[at] = old + 1e-6
            up = loss()
            value[at] = old - 1e-6
            down = loss()
            value[at] = old
            assert got[name][0][at] == pytest.approx((up - down) / 2e-6, abs=1e-5)
    gradient, rows = got["table"]
    for i, row in ((i, r) for i, r in enumerate(rows) if r):  # row 0 stays zero
        old = net.table[row, 0]
        net.table[row, 0] = old + 1e-6
        up = loss()
        net.table[row, 0] = old
        assert gradient[i, 0] == pytest.approx((up - loss()) / 1e-6, abs=1e-4)


def test_held_out_quality_and_columns(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    got = queries.QUERIES["op2_toxicity"](spark, SMALL)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    held = [(r.score, labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    score, label, said = map(np.array, zip(*held))
    assert area(score, label) > 0.85
    assert (label[said == 1] == 1).mean() > 0.8
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)


def test_scores_do_not_see_columns_or_held_out_labels(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices("red blue green one two".split(), k=9)) + (" vile" if i % 4 == 0 else ""), "en") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    label = lambda f: spark.createDataFrame([(i, f(i)) for i, _, _ in rows], "doc_id long, toxic int")
    import zlib

    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    a = toxicity.toxicity(docs, label(lambda i: int(i % 4 == 0))).collect()
    b = toxicity.toxicity(docs.drop("lang").selectExpr("*", "'x' as lang", "1.0 as score"), label(lambda i: 1 if i in held else int(i % 4 == 0))).collect()
    assert sorted(a) == sorted(b)
    assert all(r.predicted == int(r.doc_id % 4 == 0) for r in a)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "a"), (3, "b " * 30000)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.toxicity(docs, none).collect()
    assert len(rows) == 5 and len({r.score for r in rows}) == 1
    assert toxicity.toxicity(docs.limit(0), none).count() == 0
    odd = spark.createDataFrame([(1, 1), (1, 1), (2, None), (7, 0), (None, 1)], "doc_id long, toxic int")
    assert toxicity.keep_clean(docs, odd).columns == docs.columns


def test_language_of_function_words():
    assert toxicity.language_of("die katze und der hund".encode().split()) == "de"
    assert toxicity.language_of([b"zzz"]) == ""


def test_cached_scores_equal_the_network(monkeypatch):
    """What answers the query, responses of words looked up in a small cache, against the forward pass itself."""
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefgh"), 1 + i % 11)) for i in range(300)]
    texts = [" ".join(rng.choice(words, rng.integers(1, 60))) for _ in range(120)] + ["", "one", "the and of to in", "größe 東京 qa"]
    s = toxicity.Settings(buckets=1 << 10)
    net = toxicity._Net(s, rng)
    net.table[1:] *= 5
    net.bias, net.out = rng.normal(0, 0.5, net.bias.shape), rng.normal(0, 0.5, net.out.shape)
    model = toxicity.Model(s, net.table, net.filters, net.bias, net.out, {"": 0.1, "en": -0.4})
    spoken = [toxicity.letter_words(t) for t in texts]
    z = net.forward([toxicity.hashes(w, s.buckets) for w in spoken])[-1]
    at = np.array([model.thresholds.get(toxicity.language_of(w), model.thresholds[""]) for w in spoken])
    expected = 1 / (1 + np.exp(-(z - at + np.log(s.target / (1 - s.target)))))
    monkeypatch.setattr(toxicity.Scorer, "CACHED", 50)  # emptied again and again
    scorer = toxicity.Scorer(model)
    got = np.concatenate([scorer(texts[i:i + 10]) for i in range(0, len(texts), 10)])
    assert np.abs(got - expected).max() < 1e-4 and np.std(expected) > 0.05


def test_every_labelled_text_is_learned_from(spark, monkeypatch):
    """More of them than any bound, one of them long; the fold held out is the only one left out."""
    import zlib

    name = "translate(cast(id as string), '0123456789', 'abcdefghij')"
    docs = spark.range(20_000).selectExpr("id as doc_id", f"if(id = 7, repeat('long ', 30000), concat({name}, ' x')) as text")
    labels = spark.range(20_000).selectExpr("id as doc_id", "cast(id % 5 = 0 as int) as toxic")
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda rows, settings: seen.append(rows.select("codes", "toxic").toPandas()))
    toxicity.train(docs, labels)
    wanted = [i for i in range(20_000) if zlib.crc32(str(i).encode()) % 3 != 1]
    words = ["long " * 30000 if i == 7 else str(i).translate(str.maketrans("0123456789", "abcdefghij")) + " x" for i in wanted]
    assert 7 in wanted and len(wanted) > 12_000
    assert sorted(seen[0]["codes"]) == sorted(toxicity.hashes(w.encode().split(), 1 << 16).astype("<u2").tobytes() for w in words)
    assert seen[0]["toxic"].sum() == sum(i % 5 == 0 for i in wanted)


def test_several_tasks_learn_one_network(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices("red blue green one two".split(), k=9)) + (" vile" if i % 4 == 0 else "")) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, labels, settings=toxicity.Settings(shard=50)).collect()
    assert len(got) == 600 and all(r.predicted == int(r.doc_id % 4 == 0) for r in got)


def test_responses_do_not_depend_on_the_block(monkeypatch):
    s = toxicity.Settings(buckets=100)
    net, rng = toxicity._Net(s, np.random.default_rng(1)), np.random.default_rng(2)
    docs = [rng.integers(1, 100, (n, toxicity.ROWS)) for n in (40, 0, 1, 25, 2)]
    whole = net.forward(docs)
    monkeypatch.setattr(toxicity, "BLOCK", 7)
    for a, b in zip([*whole[1], *whole[2:]], [*(cut := net.forward(docs))[1], *cut[2:]]):
        assert np.allclose(a, b)
