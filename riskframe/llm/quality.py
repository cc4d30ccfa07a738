"""Quality by positive-unlabelled learning: the non-negative unbiased risk, with an estimated class prior.

Positives are trusted (labelled good); unlabelled texts are drawn from all documents; labels of bad texts are never used.
The risk of calling unlabelled texts bad, less what positives among them account for, is kept from falling below zero.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import bounded_sample, examples, fold, map_steps


@dataclass(frozen=True)
class Settings:
    """``positives``, ``unlabelled``: about how many texts of each are drawn, twice that at most. ``target``: the score of
    a text that is as likely good as bad."""

    positives: int = 2500
    unlabelled: int = 4000
    buckets: int = 1 << 14
    size: int = 8
    hidden: int = 12
    epochs: int = 8
    prior_epochs: int = 5
    batch: int = 128
    step: float = 0.05
    target: float = 0.3
    seed: int = 11


# Bytes of each kind, deleted to count them.
_KINDS = [bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58)), b".,;:?!'\"()-", b"\n",
          bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:?!'\"()-"), bytes(range(128, 256))]
_SHAPES = [(re.compile(p), r) for p, r in (("[A-ZÀ-ÖØ-Þ]+", "A"), (r"[^\W\d_A]+", "a"), (r"\d+", "0"), (r"([^\w\s])\1+", r"\1\1"))]
DENSE = len(_KINDS) + 8


def shape(token: str) -> str:
    """Runs of capitals, other letters, digits and equal signs, each as one sign (two for a run of equal signs)."""
    for pattern, sign in _SHAPES:
        token = pattern.sub(sign, token)
    return token[:12]


class Features:
    """Dense features and token codes of texts; each token is looked at once."""

    CACHED = 150_000

    def __init__(self, buckets: int):
        self.buckets, self.place, self.pairs = buckets, {}, np.zeros((0, 2), np.int32)

    def _fill(self, tokens: set[str]) -> None:
        if len(self.place) > self.CACHED:
            self.place, self.pairs = {}, self.pairs[:0]
        fresh = list(tokens.difference(self.place))
        if fresh:
            half = self.buckets // 2
            pairs = [(zlib.crc32(shape(t).encode("utf-8", "replace")) % half,
                      half + zlib.crc32(t.lower().strip(".,;:?!'\"()").encode("utf-8", "replace")) % half) for t in fresh]
            start = len(self.pairs)
            self.pairs = np.concatenate([self.pairs, np.array(pairs, np.int32)])
            self.place.update(zip(fresh, range(start, start + len(fresh))))

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, list[np.ndarray]]:
        """(texts, DENSE) and for each text its (tokens, 2) buckets."""
        split = [(t or "").split() for t in texts]
        self._fill(set().union(*split))
        dense, bags = np.zeros((len(texts), DENSE)), []
        for i, (text, tokens) in enumerate(zip(texts, split)):
            codes = np.fromiter(map(self.place.__getitem__, tokens), np.int64, len(tokens))
            bags.append(self.pairs[codes])
            raw, n, lines = (text or "").encode("utf-8", "replace"), max(len(tokens), 1), (text or "").split("\n")
            row = [1 - len(raw.translate(None, kind)) / max(len(raw), 1) for kind in _KINDS]
            row += [math.log1p(len(tokens)), len(raw) / n, len(set(tokens)) / n, math.log1p(len(set(tokens))),
                    float((codes[1:] == codes[:-1]).sum()) / n, len(set(lines)) / len(lines), math.log1p(n / len(lines)),
                    float((codes[2:] == codes[:-2]).sum()) / n]
            dense[i] = row
        return dense, bags


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


class Net:
    """One hidden layer over the dense features and the mean of hashed token embeddings."""

    def __init__(self, s: Settings, rng: np.random.Generator):
        self.s = s
        self.mean, self.spread = np.zeros(DENSE), np.ones(DENSE)
        self.table = rng.normal(0, 0.1, (s.buckets, s.size))
        self.inner = rng.normal(0, 0.3, (DENSE + s.size + 1, s.hidden))
        self.outer = rng.normal(0, 0.3, s.hidden + 1)
        self.seen: dict[str, np.ndarray] = {}

    def forward(self, dense: np.ndarray, bags: list[np.ndarray]):
        x = np.clip((dense - self.mean) / self.spread, -5, 5)
        bag = np.array([self.table[b].mean(axis=(0, 1)) if len(b) else np.zeros(self.s.size) for b in bags]).reshape(-1, self.s.size)
        x = np.concatenate([x, bag, np.ones((len(x), 1))], axis=1)
        h = np.tanh(x @ self.inner)
        return x, h, h @ self.outer[:-1] + self.outer[-1]

    def _step(self, name, value, gradient, rows=slice(None)):
        seen = self.seen.setdefault(name, np.full(value.shape, 1e-4))
        seen[rows] += gradient ** 2
        value[rows] -= self.s.step * gradient / np.sqrt(seen[rows])

    def learn(self, x, h, bags, dz) -> None:
        """One step down the gradient dz of the risk by the outputs."""
        d_h = dz[:, None] * self.outer[:-1] * (1 - h ** 2)
        d_bag = (d_h @ self.inner.T)[:, DENSE:DENSE + self.s.size]
        inner, outer = x.T @ d_h, np.append(h.T @ dz, dz.sum())
        flat = np.concatenate([b.ravel() for b in bags])
        sizes = np.array([b.size for b in bags])
        rows, back = np.unique(flat, return_inverse=True)
        each = np.repeat(d_bag / np.maximum(sizes, 1)[:, None], sizes, axis=0)
        table = np.stack([np.bincount(back, each[:, k], minlength=len(rows)) for k in range(self.s.size)], axis=1)
        self._step("inner", self.inner, inner)
        self._step("outer", self.outer, outer)
        if len(rows):
            self._step("table", self.table, table, rows)


def risk_gradient(z: np.ndarray, positive: np.ndarray, prior: float) -> np.ndarray:
    """By each output: the gradient of the non-negative risk under the sigmoid loss, or of the step back where it is below 0."""
    p, slope = _sigmoid(z), _sigmoid(z) * (1 - _sigmoid(z))
    n_p, n_u = max(positive.sum(), 1), max((~positive).sum(), 1)
    bad = p[~positive].sum() / n_u - prior * p[positive].sum() / n_p
    of_bad = np.where(positive, -prior / n_p, 1 / n_u) * slope
    of_good = np.where(positive, -prior / n_p, 0.0) * slope
    return of_good + of_bad if bad >= 0 else -of_bad


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among unlabelled texts, from scores of texts that were not learned from.

    Above any threshold, positives among the unlabelled are as frequent as among positives: the smallest ratio of the two
    tails, with an allowance for chance in thin tails, is the share.
    """
    if not len(positive) or not len(unlabelled):
        return 0.5
    cuts = np.unique(positive)
    tail_p = 1 - np.searchsorted(np.sort(positive), cuts) / len(positive)
    tail_u = 1 - np.searchsorted(np.sort(unlabelled), cuts) / len(unlabelled)
    chance = sum(math.sqrt(math.log(40) / (2 * n)) for n in (len(positive), len(unlabelled)))
    best = int(((tail_u + chance) / tail_p).argmin())
    return float(np.clip(tail_u[best] / tail_p[best], 0.05, 0.95))


def _trained(s: Settings, features, positive: np.ndarray, epochs: int, gradient, seed: int) -> Net:
    dense, bags = features
    rng = np.random.default_rng(seed)
    net = Net(s, rng)
    base = dense[~positive] if (~positive).any() else dense
    net.mean, net.spread = base.mean(axis=0), base.std(axis=0) + 1e-3
    groups = [np.flatnonzero(positive), np.flatnonzero(~positive)]
    batches = max(1, -(-len(positive) // s.batch))
    for _ in range(epochs):
        parts = [np.array_split(rng.permutation(g), batches) for g in groups]
        for some in map(np.concatenate, zip(*parts)):
            own = [bags[i] for i in some]
            x, h, z = net.forward(dense[some], own)
            net.learn(x, h, own, gradient(z, positive[some]))
    return net


@dataclass
class Model:
    settings: Settings
    net: Net
    prior: float


def fit(positives: list[str], unlabelled: list[str], settings: Settings = Settings()) -> Model:
    """Estimates the prior with a plain classifier fitted on one half and read on the other, then minimises the risk."""
    s = settings
    dense, bags = Features(s.buckets)(positives + unlabelled)
    positive = np.arange(len(dense)) < len(positives)
    if not len(positives) or not len(unlabelled):
        return Model(s, Net(s, np.random.default_rng(s.seed)), 0.5)
    half = np.arange(len(dense)) % 2 == 0
    share = positive[half].mean()

    def apart(z, y):
        return (_sigmoid(z) - y) * np.where(y, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6)) / len(z)

    first = _trained(s, (dense[half], [b for b, k in zip(bags, half) if k]), positive[half], s.prior_epochs, apart, s.seed)
    rest = np.flatnonzero(~half)
    z = first.forward(dense[rest], [bags[i] for i in rest])[2]
    prior = estimate_prior(z[positive[rest]], z[~positive[rest]])
    net = _trained(s, (dense, bags), positive, s.epochs, lambda z, y: risk_gradient(z, y, prior), s.seed + 1)
    return Model(s, net, prior)


class Scorer:
    def __init__(self, model: Model):
        self.model, self.features = model, Features(model.settings.buckets)

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        t = self.model.settings.target
        return _sigmoid(self.model.net.forward(*self.features(texts))[2] + math.log(t / (1 - t)))


def train(docs: DataFrame, labels: DataFrame, held_out: tuple[int, int] = (5, 0), settings: Settings = Settings()) -> Model:
    """Draws trusted positives outside the fold crc32(doc_id) mod n = k of ``held_out``, and unlabelled from all texts."""
    good = labels.filter((F.col("quality") == 1) & (fold(F.col("doc_id"), held_out[0]) != held_out[1])).select("doc_id").distinct()
    good = bounded_sample(good, settings.positives)
    any_ = bounded_sample(docs.select("doc_id").distinct(), settings.unlabelled, seed=23)
    drawn = [examples(docs, ids, 2 * n).toPandas()["text"].tolist()
             for ids, n in ((good, settings.positives), (any_, settings.unlabelled))]
    return fit(*drawn, settings)


def quality(docs: DataFrame, labels: DataFrame, held_out: tuple[int, int] = (5, 0), settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Null and empty texts are scored like any other, as texts without tokens; a null doc_id is not held out. Repeated rows
    stay, other columns are ignored. Without trusted positives all texts are scored by an unfitted model.
    """
    model = train(docs, labels, held_out, settings)

    def make():
        scorer = Scorer(model)
        return lambda texts: [pa.array(scorer(texts), pa.float64())]

    rows = docs.select("doc_id", (F.coalesce(fold(F.col("doc_id"), held_out[0]), F.lit(-1)) == held_out[1]).alias("held_out"), "text")
    return map_steps(rows, "text", make, "score double").withColumn("predicted", (F.col("score") >= settings.target).cast("int"))
