"""Toxicity: a convolutional text classifier, learned from all labelled texts, with thresholds calibrated by language.

A word's embedding is the sum of rows of a hashed table, for the word, its prefixes and its suffix. Filters of several widths run over the words of a whole text,
each keeps its largest response, and a logistic layer reads those. The language that sets the threshold is told from
function words of the text itself, never from a column.

In each round every task learns on from the same network over its own texts, a slice at a time; the networks are then
averaged, each by its number of texts. Counts that start the network and set the thresholds are summed over all tasks.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import fold, letter_words, map_steps, runs, small, small_batches, steps, unused
from riskframe.session import materialise

# Frequent function words by language.
FUNCTION_WORDS = {
    "de": "der die und das ist nicht mit ein zu von den auf für sich im eine des dem wird auch als es",
    "en": "the of and to in is that it for was with as be on by at this are or an from have",
    "es": "el la de que y en un por con para los del se las una su al lo como más es no",
    "fr": "le la les de et des en un une du est que pour dans qui au sur par pas il ce ne",
    "it": "il di che è la e un per non in una con del sono della le si da gli alla",
    "pt": "o de que e do da em um para com não uma os no se na por mais as dos",
}


@dataclass(frozen=True)
class Settings:
    """``shard``: labelled texts that one task learns from, about. ``target``: the score at each threshold."""

    shard: int = 16_000
    buckets: int = 1 << 16
    size: int = 8
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 6
    epochs: int = 6
    batch: int = 64
    step: float = 0.08
    calibration: int = 4
    target: float = 0.7
    seed: int = 5


@dataclass
class Model:
    settings: Settings
    table: np.ndarray  # (buckets, size)
    filters: list[np.ndarray]  # for each width (width, size, filters)
    bias: np.ndarray  # of all filters
    out: np.ndarray  # weights of all filters, then the constant
    thresholds: dict[str, float]  # log-odds by language; "" for all others


_LANGUAGE_OF: dict[bytes, list[str]] = {}
for _language, _words in FUNCTION_WORDS.items():
    for _word in _words.split():
        _LANGUAGE_OF.setdefault(_word.encode("utf-8"), []).append(_language)


def language_of(words: list[bytes]) -> str:
    """The language whose function words make up most of the text, "" where none does."""
    seen = dict.fromkeys(FUNCTION_WORDS, 0)
    for word in words:
        for language in _LANGUAGE_OF.get(word, ()):
            seen[language] += 1
    best = max(seen, key=lambda l: (seen[l], l))
    return best if seen[best] else ""


#: Bytes of the prefixes and of the suffix that a longer word shares with others.
PREFIXES, SUFFIX = (4, 6, 8), 5
ROWS = 3 + len(PREFIXES)


def hashes(words: list[bytes], buckets: int) -> np.ndarray:
    """ROWS buckets of each word: two of the whole, of its prefixes and of its suffix; 0 for none of these and for gaps."""
    n, crc = buckets - 1, zlib.crc32
    rows = [(crc(w) % n + 1, crc(w, 1) % n + 1,
             *[crc(w[:k], 2) % n + 1 if len(w) > k else 0 for k in PREFIXES],
             crc(w[-SUFFIX:], 3) % n + 1 if len(w) > SUFFIX else 0) for w in words]
    return np.array(rows, np.int32).reshape(-1, ROWS)


#: Words whose responses the network holds at once; doubles that a part of a summed array has; steps in one unit of log-odds
#: that thresholds are told apart by, and the largest log-odds that count.
BLOCK, PART, STEPS, MOST = 50_000, 16_384, 256, 32


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


class _Net:
    """Forward and backward over a batch of texts, given as hashed words."""

    def __init__(self, s: Settings, rng: np.random.Generator):
        self.s, k = s, s.filters * len(s.widths)
        self.table = rng.normal(0, 0.1, (s.buckets, s.size))
        self.table[0] = 0.0
        self.filters = [rng.normal(0, 0.3, (w, s.size, s.filters)) for w in s.widths]
        for f in self.filters:
            f[0, 0, :] = np.abs(f[0, 0, :]) + 0.3
        self.bias, self.out = np.zeros(k), np.append(np.full(k, 0.3), 0.0)
        self.seen = {}

    def _adagrad(self, name, value, gradient, rows=None):
        seen = self.seen.setdefault(name, np.full(value.shape, 1e-3))
        if rows is None:
            seen += gradient ** 2
            value -= self.s.step * gradient / np.sqrt(seen)
        else:
            seen[rows] += gradient ** 2
            value[rows] -= self.s.step * gradient / np.sqrt(seen[rows])

    def embed(self, words: np.ndarray) -> np.ndarray:
        return sum(self.table[words[..., i]] for i in range(ROWS))

    def forward(self, docs: list[np.ndarray]):
        """Hashed words behind each other, places of the largest responses, these, and log-odds; BLOCK words at a time."""
        gap = max(self.s.widths)
        sizes = np.array([len(d) + gap for d in docs])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        n = int(sizes.sum())
        words = np.zeros((n + gap, ROWS), np.int32)
        for a, d in zip(starts, docs):
            words[a:a + len(d)] = d
        pooled = [np.full((len(docs), self.s.filters), -np.inf) for _ in self.s.widths]
        places = [np.zeros((len(docs), self.s.filters), np.int64) for _ in self.s.widths]
        for low in range(0, n, BLOCK):
            high = min(n, low + BLOCK)
            e = self.embed(words[low:high + gap])
            first, last = np.searchsorted(starts, [low, high - 1], "right") - 1
            cuts = np.maximum(starts[first:last + 1], low) - low
            ends = np.append(cuts[1:], high - low)
            for width, f, best, where in zip(self.s.widths, self.filters, pooled, places):
                response = sum(e[j:j + high - low] @ f[j] for j in range(width))
                for j in range(1, width):
                    out = starts + sizes - j - low
                    response[out[(out >= 0) & (out < high - low)]] = -np.inf  # would reach into the next text
                for i, a, b in zip(range(first, last + 1), cuts, ends):
                    at = response[a:b].argmax(axis=0)
                    top = response[a + at, np.arange(self.s.filters)]
                    better = top > best[i]
                    best[i, better], where[i, better] = top[better], (low + a + at)[better]
        raw = np.concatenate(pooled, axis=1) + self.bias
        return words, places, raw, np.maximum(raw, 0) @ self.out[:-1] + self.out[-1]

    def learn(self, docs: list[np.ndarray], labels: np.ndarray, weights: np.ndarray) -> None:
        words, places, raw, z = self.forward(docs)
        dz = (_sigmoid(z) - labels) * weights / len(docs)
        active = np.maximum(raw, 0)
        d_raw = dz[:, None] * self.out[:-1] * (raw > 0)
        d_out = np.append(active.T @ dz, dz.sum())
        k, touched, d_e = self.s.filters, [], []
        for i, (width, f, where) in enumerate(zip(self.s.widths, self.filters, places)):
            d = d_raw[:, i * k:(i + 1) * k]
            d_f = np.zeros_like(f)
            for j in range(width):
                at = where + j
                d_f[j] = np.einsum("nks,nk->sk", self.embed(words[at]), d)
                touched.append(words[at].reshape(-1, ROWS))
                d_e.append((d[:, :, None] * f[j].T[None, :, :]).reshape(-1, self.s.size))
            self._adagrad(f"filter{i}", f, d_f)
        self._adagrad("out", self.out, d_out)
        self._adagrad("bias", self.bias, d_raw.sum(axis=0))
        rows, back = np.unique(np.concatenate(touched).ravel(), return_inverse=True)
        gradient = np.zeros((len(rows), self.s.size))
        np.add.at(gradient, back, np.repeat(np.concatenate(d_e), ROWS, axis=0))
        gradient[rows == 0] = 0.0
        self._adagrad("table", self.table, gradient, rows)

    def _parts(self) -> list[np.ndarray]:
        """All that learning changes: weights, then what ``_adagrad`` has seen of them."""
        weights = {"table": self.table, "out": self.out, "bias": self.bias, **{f"filter{i}": f for i, f in enumerate(self.filters)}}
        return [*weights.values(), *[self.seen.setdefault(name, np.full(value.shape, 1e-3)) for name, value in weights.items()]]

    def state(self) -> np.ndarray:
        return np.concatenate([part.ravel() for part in self._parts()])

    def restore(self, state: np.ndarray) -> None:
        at = 0
        for part in self._parts():
            part.ravel()[:] = state[at:at + part.size]
            at += part.size


def _start_from_odds(table: np.ndarray, seen: np.ndarray, n: np.ndarray) -> None:
    """First coordinate of each row: a part of the smoothed log-odds of the label given the bucket.

    ``n`` has the texts of both labels, ``seen`` those of them that hold each bucket.
    """
    positive = max(n[1] / n.sum(), 1e-6)
    prior = 5.0
    odds = np.log((seen[1] + prior * positive) / (seen[0] + prior * (1 - positive))) - math.log(positive / max(1 - positive, 1e-6))
    table[:, 0] += 0.4 * odds
    table[0] = 0.0


def _threshold(steps_down: list[tuple[int, int, int]], first: float) -> float:
    """The log-odds that divides the labels best, half-way to the next step; ``first`` where there is no choice.

    ``steps_down``: (step of 1/STEPS, texts, toxic ones), downwards. Best by F0.5: a clean document that goes weighs more
    than a toxic one that stays.
    """
    at, n, toxic = (np.array(column) for column in zip(*steps_down))
    if not toxic.any() or (toxic == n).all():
        return first
    score = 1.25 * np.cumsum(toxic) / (np.cumsum(n) + 0.25 * toxic.sum())
    best = int(score.argmax())
    low = at[best + 1] + 1 if best + 1 < len(at) else at[best] - STEPS
    return float(at[best] + low) / 2 / STEPS


class Coder:
    """Texts as the hashes of their words, ROWS numbers a word, and the languages they are in; the hashes of a word are kept."""

    CACHED = 100_000

    def __init__(self, buckets: int):
        self.buckets, self.kind, self.kept = buckets, _kind(buckets), {}

    def __call__(self, texts: list[str | None]) -> tuple[list[bytes], list[str]]:
        words = [letter_words(t or "") for t in texts]
        if len(self.kept) > self.CACHED:
            self.kept = {}
        for fresh in runs(list(set().union(*words).difference(self.kept)), 20_000):
            self.kept.update(zip(fresh, map(bytes, hashes(fresh, self.buckets).astype(self.kind))))
        return [b"".join(map(self.kept.__getitem__, own)) for own in words], list(map(language_of, words))


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def _docs(column: pa.Array, s: Settings) -> list[np.ndarray]:
    return [np.frombuffer(codes, _kind(s.buckets)).reshape(-1, ROWS) for codes in column.to_pylist()]


def _summed(rows: DataFrame, make: Callable[[Iterator], Iterator[tuple[np.ndarray, int]]]) -> tuple[np.ndarray | None, int]:
    """The sum over all tasks of the (array, number) that ``make`` gives from its batches, at most once a task.

    Arrays are added up a part at a time, so that no task and not the driver holds those of all tasks.
    """
    def parts(batches):
        for array, n in make(batches):
            for i, at in enumerate(range(0, array.size, PART)):
                yield pa.RecordBatch.from_pydict({"part": pa.array([i], pa.int32()), "n": pa.array([n], pa.int64()),
                                                  "sums": pa.array([array[at:at + PART].astype("<f4").tobytes()], pa.binary())})

    def add(batches):
        sums: dict[int, tuple] = {}
        for batch in batches:
            for part, n, data in zip(*(column.to_pylist() for column in batch.columns)):
                before = sums.get(part, (0, 0.0))
                sums[part] = before[0] + n, before[1] + np.frombuffer(data, "<f4").astype(float)
        for part, (n, array) in sums.items():
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "n": pa.array([n], pa.int64()),
                                              "sums": pa.array([array.tobytes()], pa.binary())})

    kind = "part int, n bigint, sums binary"
    found = rows.mapInArrow(parts, kind).repartition("part").mapInArrow(add, kind).toPandas().sort_values("part")
    if not len(found):
        return None, 0
    return np.concatenate([np.frombuffer(data, "<f8") for data in found["sums"]]), int(found["n"].iloc[0])


def _counts_of_buckets(s: Settings):
    """For ``_summed``: texts of each label that hold each bucket."""
    def make(batches):
        seen, n = np.zeros((2, s.buckets)), 0
        for step in steps(batches, "codes"):
            for d, y in zip(_docs(step.column("codes"), s), step.column("toxic").to_pylist()):
                seen[int(y), np.unique(d)] += 1
                n += 1
        if n:
            yield seen.ravel(), n

    return make


def _one_round(s: Settings, state: np.ndarray, share: float, number: int):
    """For ``_summed``: how the texts of a task have changed the network, times their number; mostly zeros."""
    def make(batches):
        net, rng, n = _Net(s, np.random.default_rng(s.seed)), np.random.default_rng([s.seed, number]), 0
        net.restore(state)
        docs, y = [], np.zeros(0)

        def learn(order: np.ndarray) -> None:
            weights = np.where(y == 1, min(5.0, 0.5 / share), 0.5 / (1 - share))
            for some in (order[a:a + s.batch] for a in range(0, len(order), s.batch)):
                net.learn([docs[i] for i in some], y[some], weights[some])

        for step in steps(batches, "codes"):
            docs, y = docs + _docs(step.column("codes"), s), np.append(y, step.column("toxic").to_numpy())
            n += step.num_rows
            order = rng.permutation(len(docs))
            whole = len(order) // s.batch * s.batch  # the rest waits for the next step
            learn(order[:whole])
            docs, y = [docs[i] for i in order[whole:]], y[order[whole:]]
        learn(np.arange(len(docs)))
        if n:
            yield (net.state() - state) * n, n

    return make


def fit(rows: DataFrame, settings: Settings = Settings()) -> Model:
    """Learns from all ``rows`` (codes, language, toxic, held), read once a round, and sets the thresholds on those held back.

    ``rows`` must be a written table of what ``Coder`` gives. The held ones are learned from too if there are too few of them.
    """
    s = settings
    net = _Net(s, np.random.default_rng(s.seed))
    counts = {(r.held, r.toxic): r["count"] for r in rows.groupBy("held", "toxic").count().collect()}
    of = lambda y, *held: sum(counts.get((h, y), 0) for h in held)
    every = np.array([of(0, False, True), of(1, False, True)])
    if not every.all():  # nothing to tell apart
        level = 0.0 if not every.any() else (4.0 if every[1] else -4.0)
        net.out[:] = np.append(np.zeros(len(net.bias)), level)
        return Model(s, net.table, net.filters, net.bias, net.out, {"": math.log(s.target / (1 - s.target))})
    both = not (of(0, False) and of(1, False)) or every[1] < 8 or not of(0, True) + of(1, True)
    learn, check = (rows, rows) if both else (rows.filter(~F.col("held")), rows.filter("held"))
    n = every if both else np.array([of(0, False), of(1, False)])
    learn = learn.select("codes", "toxic")
    small_batches(rows.sparkSession)
    seen, _ = _summed(learn, _counts_of_buckets(s))
    _start_from_odds(net.table, seen.reshape(2, -1), n)
    for number in range(s.epochs):
        total, texts = _summed(learn, _one_round(s, net.state(), n[1] / n.sum(), number))
        net.restore(net.state() + total / texts)
    return Model(s, net.table, net.filters, net.bias, net.out, _thresholds(check, s, net.state()))


def _thresholds(rows: DataFrame, s: Settings, state: np.ndarray) -> dict[str, float]:
    """The best threshold of each language, from counts of all ``rows`` by steps of their log-odds."""
    def told(batches):
        net = _Net(s, np.random.default_rng(s.seed))
        net.restore(state)
        for step in steps(batches, "codes"):
            z = np.concatenate([net.forward(some)[-1] for some in runs(_docs(step.column("codes"), s), s.batch)])
            at = pa.array(np.floor(np.clip(z, -MOST, MOST) * STEPS).astype(int), pa.int32())
            yield pa.RecordBatch.from_arrays([at, step.column("language"), step.column("toxic")], ["step", "language", "toxic"])

    steps_of = rows.select("codes", "language", "toxic").mapInArrow(told, "step int, language string, toxic int")
    counted = steps_of.groupBy("language", "step").agg(F.count("*").alias("n"), F.sum("toxic").cast("long").alias("toxic")).collect()

    def down(language: str | None = None) -> list[tuple[int, int, int]]:
        sums: dict[int, list[int]] = {}
        for r in counted:
            if language in (None, r.language):
                own = sums.setdefault(r.step, [0, 0])
                own[0], own[1] = own[0] + r.n, own[1] + r.toxic
        return [(step, *sums[step]) for step in sorted(sums, reverse=True)]

    every = _threshold(down(), 0.0)
    thresholds = {"": every}
    for language in {r.language for r in counted} - {""}:
        n = sum(r.toxic for r in counted if r.language == language)
        mixed = n / (n + 10)  # few cases lean on the common threshold
        thresholds[language] = mixed * _threshold(down(language), every) + (1 - mixed) * every
    return thresholds


class Scorer:
    """Scores of texts; the responses of each word to all filters are looked up, not computed again."""

    CACHED = 100_000

    def __init__(self, model: Model):
        self.m, s = model, model.settings
        self.columns = np.concatenate([f for f in model.filters]).transpose(1, 0, 2).reshape(s.size, -1).astype(np.float32)
        self.table = model.table.astype(np.float32)
        self.place: dict[bytes, int] = {}
        self.responses = np.zeros((1, self.columns.shape[1]), np.float32)  # row 0: the gap

    def _fill(self, words: set[bytes]) -> None:
        if len(self.place) > self.CACHED:
            self.place, self.responses = {}, self.responses[:1]
        fresh = list(words.difference(self.place))
        if fresh:
            self.place.update(zip(fresh, range(len(self.responses), len(self.responses) + len(fresh))))
            self.responses = np.concatenate([self.responses, *map(self._respond, runs(fresh, 20_000))])

    def _respond(self, words: list[bytes]) -> np.ndarray:
        at = hashes(words, self.m.settings.buckets)
        return sum(self.table[at[:, i]] for i in range(ROWS)) @ self.columns

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        s = self.m.settings
        words = [letter_words(t or "") for t in texts]
        self._fill(set().union(*words))
        gap, scores = max(s.widths), np.zeros(len(texts))
        for i, own in enumerate(words):
            codes = np.zeros(len(own) + gap, np.int64)
            codes[:len(own)] = np.fromiter(map(self.place.__getitem__, own), np.int64, len(own))
            pooled, column = [], 0
            for width in s.widths:
                n = len(codes) - width + 1
                response = np.zeros((n, s.filters), np.float32)
                for j in range(width):
                    response += self.responses[codes[j:j + n], column:column + s.filters]
                    column += s.filters
                pooled.append(response.max(axis=0))
            z = np.maximum(np.concatenate(pooled) + self.m.bias, 0) @ self.m.out[:-1] + self.m.out[-1]
            at = self.m.thresholds.get(language_of(own), self.m.thresholds[""])
            scores[i] = _sigmoid(z - at + math.log(s.target / (1 - s.target)))
        return scores


def train(docs: DataFrame, labels: DataFrame, held_out: tuple[int, int] = (3, 1), settings: Settings = Settings()) -> Model:
    """Fits on all labelled documents outside the fold crc32(doc_id) mod n = k of ``held_out``, whole texts of any length.

    One in ``settings.calibration`` of them sets the thresholds, the others the network. They are written once, in an
    order by hash, as files of about ``settings.shard`` texts.
    """
    told = labels.filter(F.col("toxic").isin(0, 1) & (fold(F.col("doc_id"), held_out[0]) != held_out[1]))
    told = small(materialise(told.select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct(), "toxic-labels"))
    n = docs.select("doc_id").join(told, "doc_id").count()
    place = F.xxhash64(F.lit(settings.seed), "doc_id", "text", "toxic")
    rows = docs.select("doc_id", "text").join(told, "doc_id").select("text", "toxic", place.alias("place"))

    def make():
        coder = Coder(settings.buckets)

        def each(texts):
            codes, spoken = coder(texts)
            return [pa.array(codes, pa.binary()), pa.array(spoken, pa.string())]

        return each

    rows = map_steps(rows, "text", make, "codes binary, language string")
    rows = rows.repartition(-(-n // settings.shard) or 1, "place").sortWithinPartitions("place")
    held = F.pmod("place", F.lit(settings.calibration)) == 0
    return fit(materialise(rows.select("codes", "language", "toxic", held.alias("held")), "toxic-examples"), settings)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with score in place of text: 0 to 1, ``settings.target`` at the threshold of the text's language."""

    def make():
        scorer = Scorer(model)
        return lambda texts: [pa.array(scorer(texts), pa.float64())]

    return map_steps(docs, "text", make, "score double")


def toxicity(docs: DataFrame, labels: DataFrame, held_out: tuple[int, int] = (3, 1), settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Null and empty texts have no words and get the score of that; a null doc_id is not held out. Repeated rows stay, other
    columns are ignored. Without labels of both kinds all scores are equal.
    """
    model = train(docs, labels, held_out, settings)
    rows = docs.select("doc_id", (F.coalesce(fold(F.col("doc_id"), held_out[0]), F.lit(-1)) == held_out[1]).alias("held_out"), "text")
    return score(rows, model).withColumn("predicted", (F.col("score") >= settings.target).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` without those that are predicted toxic; all columns stay."""
    model, keep = train(docs, labels, settings=settings), unused(docs, "__keep")

    def make():
        scorer = Scorer(model)
        return lambda texts: [pa.array(texts, pa.string()), pa.array(scorer(texts) < settings.target, pa.bool_())]

    told = map_steps(docs, "text", make, f"text string, {keep} boolean")
    return told.filter(F.col(keep)).select(*docs.columns)
