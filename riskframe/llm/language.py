"""Language ID by segmentation-marginalised unigrams over a fixed public vocabulary.

Each language has a probability for every piece of the vocabulary. A word's probability is the sum over all ways to cut it
into pieces, by a forward pass; the probabilities come from expectation maximisation over the same lattice. A text is its
words, lower-case runs of letters, each with the mark of a word's start; words are scored once and looked up.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import EXAMPLE_CHARS, bounded_sample, fold, letter_words, map_steps, runs, unused
from riskframe.session import materialise

#: Documents that each language is fitted on; rounds of fitting; what is added to each piece's count.
SAMPLE, ROUNDS, ADDED = 400, 4, 0.05
#: Documents above EXAMPLE_CHARS that each language is fitted on; languages that a model may have.
LONG_SAMPLE, MOST_LANGUAGES = 4, 1_000
#: Words kept by a worker before it starts anew, and scores of words by language.
CACHED, CACHED_SCORES = 150_000, 4_000_000
#: Words whose cuts are held in memory together.
WORDS_AT_ONCE = 10_000
START = "▁"
_LETTER = regex.compile(r"\p{L}")


def read_pieces(path: str) -> dict[str, int]:
    """The letter pieces of a sentencepiece file, numbered; a start mark may come before the letters or stand alone."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())
             if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return {p: i for i, p in enumerate(n for n in names if (n.removeprefix(START) or "a").isalpha())}


_TURN = np.uint64(0x9E3779B97F4A7C15)  # odd, so that a prefix's hash keeps all its bits


class Prefixes:
    """All prefixes of the pieces by hash: the number of the piece, or -1 where a prefix is none itself."""

    def __init__(self, pieces: dict[str, int]):
        found = {piece[:i]: -1 for piece in pieces for i in range(1, len(piece))} | pieces
        self.bits = max(4, (4 * len(found)).bit_length())
        self.keys, self.values = np.zeros(1 << self.bits, np.uint64), np.full(1 << self.bits, -2, np.int32)
        texts = list(found)
        for text, h in zip(texts, map(self._hash, texts)):
            slot = h >> (64 - self.bits)
            while self.keys[slot]:
                slot = (slot + 1) % len(self.keys)
            self.keys[slot], self.values[slot] = h, found[text]

    @staticmethod
    def _hash(text: str) -> int:
        h = 0
        for c in text:
            h = (h + ord(c) + 1) * int(_TURN) % (1 << 64)
        return h

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The value of each hash, -2 where there is none."""
        slot = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        while True:
            other = np.flatnonzero((self.keys[slot] != hashes) & (self.keys[slot] != 0))
            if not len(other):
                return np.where(self.keys[slot] == hashes, self.values[slot], -2)
            slot[other] = (slot[other] + 1) % len(self.keys)


@dataclass
class Model:
    """Log-probabilities (languages x pieces, the last one for a character that no piece holds)."""

    languages: list[str]
    prefixes: Prefixes
    log_p: np.ndarray


class Lattice:
    """The cuts of many words at once: edges from a place in a word to a later one, each a piece.

    Words lie end to end; places are numbered through, ``begin`` to ``end`` for each word. Edges are grouped by the distance
    of their end from the word's begin and by length: the edges of a group end at different places, so that one step of a
    pass serves all words. Probabilities are raised by SCALE for each character to stay in range; words longer than that
    allows are added up as logarithms.
    """

    LONG, SCALE = 50, 5.0

    def __init__(self, words: list[str], prefixes: Prefixes, unknown: int):
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.end = np.cumsum(sizes + 1) - 1
        self.begin = self.end - sizes
        self.places = int(self.end[-1]) + 1 if len(words) else 0
        self.in_logs = bool(len(words)) and int(sizes.max()) > self.LONG
        points = np.frombuffer((" ".join(words) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)[:self.places]
        offset = np.arange(self.places) - np.repeat(self.begin, sizes + 1)
        inside = np.ones(self.places, bool)
        inside[self.end] = False
        at = np.flatnonzero(inside)
        hashes, length, edges = np.zeros(len(at), np.uint64), 0, []
        while len(at):
            length += 1
            hashes = (hashes + points[at + length - 1] + np.uint64(1)) * _TURN
            value = prefixes.find(hashes)
            if length == 1:
                edges.append((at, np.where(value >= 0, value, unknown), length))
            else:
                hit = value >= 0
                edges.append((at[hit], value[hit], length))
            more = (value > -2) & inside[at + length]
            at, hashes = at[more], hashes[more]
        source = np.concatenate([e[0] for e in edges]) if edges else np.zeros(0, np.int64)
        sizes_ = np.concatenate([np.full(len(e[0]), e[2]) for e in edges]) if edges else source
        piece = np.concatenate([e[1] for e in edges]) if edges else source
        group = (offset[source] + sizes_) * (length + 1) + sizes_
        if len(group) and group.max() < 1 << 16:
            group = group.astype(np.uint16)  # sorted by counting
        order = np.argsort(group, kind="stable")
        self.source, self.piece, self.length = source[order], piece[order], sizes_[order]
        self.target = self.source + self.length
        group = group[order]
        self.cuts = np.r_[0, np.flatnonzero(group[1:] != group[:-1]) + 1, len(group)] if len(group) else np.zeros(1, int)

    def _weights(self, log_p: np.ndarray) -> np.ndarray:
        """(edges, kinds): what each edge multiplies by, or adds as a logarithm."""
        raised = log_p.T[self.piece] + self.SCALE * self.length[:, None]
        return raised if self.in_logs else np.exp(raised)

    def _pass(self, weights, start, source, target, cuts):
        sums = np.full((self.places, weights.shape[1]), -np.inf if self.in_logs else 0.0)
        sums[start] = 0.0 if self.in_logs else 1.0
        for a, b in cuts:
            to = target[a:b]
            if self.in_logs:
                sums[to] = np.logaddexp(sums[to], sums[source[a:b]] + weights[a:b])
            else:
                sums[to] += sums[source[a:b]] * weights[a:b]
        return sums

    def log_words(self, log_p: np.ndarray) -> np.ndarray:
        """(words, kinds): log of the summed probability of all cuts of each word; log_p is (kinds, pieces)."""
        sums = self._pass(self._weights(log_p), self.begin, self.source, self.target, zip(self.cuts, self.cuts[1:]))[self.end]
        return (sums if self.in_logs else np.log(sums)) - self.SCALE * (self.end - self.begin)[:, None]

    def expected(self, log_p: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Expected counts of the pieces (one language), each word counting ``times``."""
        weights, cuts = self._weights(log_p[None, :]), list(zip(self.cuts, self.cuts[1:]))
        alpha = self._pass(weights, self.begin, self.source, self.target, cuts)[:, 0]
        beta = self._pass(weights, self.end, self.target, self.source, reversed(cuts))[:, 0]
        word = np.repeat(np.arange(len(self.begin)), self.end - self.begin + 1)[self.source]
        whole = alpha[self.end][word]
        if self.in_logs:
            share = np.exp(alpha[self.source] + weights[:, 0] + beta[self.target] - whole)
        else:
            share = alpha[self.source] * weights[:, 0] * beta[self.target] / whole
        return np.bincount(self.piece, share * times[word], minlength=len(log_p))


def lattices(words: list[str], prefixes: Prefixes, unknown: int) -> list[tuple[np.ndarray, Lattice]]:
    """Places in ``words`` and their lattice, short and long words apart."""
    long = np.fromiter((len(w) > Lattice.LONG for w in words), bool, len(words))
    return [(places, Lattice([words[i] for i in places], prefixes, unknown))
            for places in (np.flatnonzero(~long), np.flatnonzero(long)) if len(places)]


def fit(words: dict[str, dict[str, int]], pieces: dict[str, int], rounds: int = ROUNDS) -> Model:
    """Piece probabilities of each language from its word counts."""
    return fit_each(((language, words[language]) for language in sorted(words)), pieces, rounds)


def fit_each(counted: Iterable[tuple[str, dict[str, int]]], pieces: dict[str, int], rounds: int = ROUNDS) -> Model:
    """The same from languages and their word counts in turn, so that the words of one at a time are held."""
    languages, prefixes, log_p = [], Prefixes(pieces), []
    for language, words in counted:
        languages.append(language)
        parts = lattices(list(words), prefixes, len(pieces))
        times = np.array(list(words.values()), float)
        p = np.full(len(pieces) + 1, -np.log(len(pieces) + 1))
        for _ in range(rounds):
            counts = sum(lattice.expected(p, times[places]) for places, lattice in parts) + ADDED
            p = np.log(counts / counts.sum())
        log_p.append(p)
    return Model(languages, prefixes, np.array(log_p).reshape(len(languages), len(pieces) + 1))


def words_of(text: str | None) -> list[bytes]:
    return letter_words(text or "")


def _word_text(word: bytes) -> str:
    return START + word.decode("utf-8", "replace")


def train(docs: DataFrame, path: str, held_out: tuple[int, int] = (4, 2), sample: int = SAMPLE) -> Model:
    """A model from text and non-null lang of the documents outside the fold crc32(doc_id) mod n = k of ``held_out``.

    About ``sample`` documents of every language are used, of those above EXAMPLE_CHARS about LONG_SAMPLE; counts of their
    words are summed on the executors. More than MOST_LANGUAGES are an error: a worker holds all piece probabilities.
    """
    learn = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id"), held_out[0]) != held_out[1]))
    learn, long = learn.select("doc_id", "lang", "text"), F.length("text") > EXAMPLE_CHARS
    chosen = bounded_sample(learn.filter(~long), sample, per="lang")
    chosen = chosen.union(bounded_sample(learn.filter(long), LONG_SAMPLE, per="lang")).select("lang", "text")

    def make():
        kind = pa.map_(pa.string(), pa.int64())
        return lambda texts: [pa.array([list(Counter(w.decode("utf-8", "replace") for w in words_of(t)).items()) for t in texts], kind)]

    counted = map_steps(chosen, "text", make, "words map<string,bigint>").select("lang", F.explode("words").alias("word", "n"))
    counted = materialise(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "language-words")
    many = counted.agg(F.count_distinct("lang")).first()[0]
    if many > MOST_LANGUAGES:
        raise ValueError(f"{many} languages; at most {MOST_LANGUAGES} fit a worker's memory")
    rows = counted.orderBy("lang", "word").toLocalIterator()
    return fit_each(((lang, {START + r.word: r.n for r in own}) for lang, own in groupby(rows, lambda r: r.lang)), read_pieces(path))


class Scorer:
    """Sums of word log-probabilities; every word is scored once."""

    def __init__(self, model: Model):
        self.model, self.place = model, {}
        self.table = np.zeros((0, len(model.languages)))

    def _fill(self, words: set[bytes]) -> None:
        if len(self.place) > min(CACHED, CACHED_SCORES // max(1, len(self.model.languages))):
            self.place, self.table = {}, self.table[:0]
        fresh = list(words.difference(self.place))
        if fresh:
            self.place.update(zip(fresh, range(len(self.table), len(self.table) + len(fresh))))
            self.table = np.concatenate([self.table, *map(self._score, runs(fresh, WORDS_AT_ONCE))])

    def _score(self, words: list[bytes]) -> np.ndarray:
        m = self.model
        scores = np.zeros((len(words), len(m.languages)))
        for places, lattice in lattices([_word_text(w) for w in words], m.prefixes, m.log_p.shape[1] - 1):
            scores[places] = lattice.log_words(m.log_p)
        return scores

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float]]:
        words = [words_of(t) if t and _LETTER.search(t) else [] for t in texts]
        self._fill(set().union(*words))
        out = []
        for w in words:
            if not w or not self.model.languages:
                out.append(("und", 0.0))
                continue
            places = np.fromiter(map(self.place.__getitem__, w), np.int64, len(w))
            total = self.table[places].sum(axis=0)
            share = np.exp(total - total.max())
            best = int(total.argmax())
            out.append((self.model.languages[best], float(1.0 / share.sum())))
        return out


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score in place of text.

    score is the share of the best language in the summed probability of all learned ones, each as likely beforehand.
    A text that is null, empty or without a letter has ``und`` and score 0, as all have where nothing could be learned.
    """

    def make():
        scorer = Scorer(model)

        def step(texts):
            found = scorer(texts)
            return [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]

        return step

    return map_steps(docs, "text", make, "lang_pred string, score double")


def identify(docs: DataFrame, path: str, held_out: tuple[int, int] = (4, 2)) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``; other columns are ignored, repeated rows stay."""
    model = train(docs, path, held_out)
    rows = docs.select("doc_id", (F.coalesce(fold(F.col("doc_id"), held_out[0]), F.lit(-1)) == held_out[1]).alias("held_out"), "text")
    return predict(rows, model)


#: A document is kept with at least this share for its best language.
KEPT_SHARE = 0.5


def keep_identified(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` without those that have no letters or whose language stays open (see KEPT_SHARE); all columns stay."""
    model, keep = train(docs, path), unused(docs, "__keep")

    def make():
        scorer = Scorer(model)

        def step(texts):
            kept = [lang != "und" and score >= KEPT_SHARE for lang, score in scorer(texts)]
            return [pa.array(texts, pa.string()), pa.array(kept, pa.bool_())]

        return step

    told = map_steps(docs.select("text", *[c for c in docs.columns if c != "text"]), "text", make, f"text string, {keep} boolean")
    return told.filter(F.col(keep)).select(*docs.columns)
