"""Byte-level BPE: pre-tokens from codepoint classes and a scan of transition functions, then cached pair merging.

The texts of a step lie end to end in one codepoint array. Whether a codepoint starts a pre-token follows from the classes
around it, except behind a contraction ('s, 'll ...), whose letters must not start one and whose end must. That memory has
four states, so each codepoint is a function of four states in one byte; functions compose by a table, composition is
associative, and a blocked prefix scan gives the state before every codepoint.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Callable, Iterable
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskframe.llm.common import map_steps, small_batches
from riskframe.llm.pair_merge import LONGEST, PairMerger

# The white space of Unicode; the suffixes that an apostrophe joins.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SUFFIXES = ["s", "t", "re", "ve", "m", "ll", "d"]

LETTER, NUMBER, SIGN, SPACE, BETWEEN = 0, 1, 2, 3, 4
#: A lone surrogate, which no text can hold, lies between texts.
SEPARATOR = "\ud800"
#: Pre-tokens kept in each of the two generations of a worker's cache.
CACHED = 120_000


@cache
def classes() -> np.ndarray:
    """The class of every codepoint."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.array([kinds.get(unicodedata.category(chr(c))[0], SIGN) for c in range(0x110000)], np.uint8)
    table[WHITE] = SPACE
    table[ord(SEPARATOR)] = BETWEEN
    return table


# States: 0 ordinary, 1 and 2 letters of a contraction to come, 3 a contraction has just ended.
# A function is four states of two bits each, state s at bits 2s and 2s + 1.
def _function(*to: int) -> int:
    return sum(t << 2 * s for s, t in enumerate(to))


PLAIN, ONE_LETTER, TWO_LETTERS = _function(0, 3, 1, 0), _function(1, 3, 1, 1), _function(2, 3, 1, 2)
RESET = _function(0, 0, 0, 0)


@cache
def _composed() -> np.ndarray:
    """At [f << 8 | g] the function that applies f, then g."""
    f, g = np.divmod(np.arange(1 << 16), 256)
    out = np.zeros(1 << 16, np.int64)
    for s in range(4):
        out |= (g >> 2 * (f >> 2 * s & 3) & 3) << 2 * s
    return out.astype(np.uint8)


def _scan(functions: np.ndarray) -> np.ndarray:
    """The state before each place, from state 0, by a scan inside blocks and one over the blocks."""
    table, n = _composed(), len(functions)
    width = max(1, int(n ** 0.5))
    rows = -(-n // width)
    block = np.full(rows * width, _function(0, 1, 2, 3), np.uint8)
    block[:n] = functions
    block = np.ascontiguousarray(block.reshape(rows, width).T).astype(np.uint16)  # a step of all blocks lies together
    for i in range(1, width):
        block[i] = table[block[i - 1] << 8 | block[i]]
    whole, step = block[-1].copy(), 1
    while step < rows:  # doubling: after it, whole[b] is the function of blocks 0 to b
        whole[step:] = table[whole[:-step] << 8 | whole[step:]]
        step *= 2
    entry = np.concatenate([[0], whole[:-1] & 3]).astype(np.uint16)  # the state in which each block begins
    after = (block >> 2 * entry[None, :]) & 3
    before = np.concatenate([entry[None, :], after[:-1]]).T.reshape(-1)
    return before[:n].astype(np.uint8)


def boundaries(points: np.ndarray) -> np.ndarray:
    """Where pre-tokens start in codepoints that begin and end with the separator."""
    kind = classes()[points]
    before, after = np.roll(kind, 1), np.roll(kind, -1)
    gap, blank = kind == SPACE, points == 32
    glued = np.roll(blank, 1) & (before == SPACE)  # a plain blank belongs to what follows it, unless that is white space
    start = np.where(gap, (before != SPACE) | ((after != SPACE) & (after != BETWEEN)), (before != kind) & ~glued)
    functions = np.full(len(points), PLAIN, np.uint8)
    quotes = np.nonzero((points == ord("'")) & (before != SIGN) & ~glued)[0]
    letters = [points[np.minimum(quotes + i, len(points) - 1)] for i in (1, 2)]
    for suffix in SUFFIXES:
        fits = np.logical_and.reduce([letters[i] == ord(c) for i, c in enumerate(suffix)])
        functions[quotes[fits]] = ONE_LETTER if len(suffix) == 1 else TWO_LETTERS
    functions[kind == BETWEEN] = RESET
    state = _scan(functions)
    return np.nonzero((state == 3) | ((state == 0) & start) | (kind == BETWEEN))[0]


def pre_tokens(texts: list[str]) -> list[list[str]]:
    """The pre-tokens of each text."""
    joined = SEPARATOR + SEPARATOR.join(texts) + SEPARATOR
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    at = boundaries(points)
    ends = np.append(at[1:], len(points)).tolist()
    pieces = [joined[a:b] for a, b in zip(at.tolist(), ends)]
    marks = np.nonzero(points[at] == ord(SEPARATOR))[0].tolist()
    return [pieces[a + 1:b] for a, b in zip(marks, marks[1:])]


def _pairs(ranks: dict[bytes, int]) -> list[tuple[int, int, int]]:
    """(left id, right id, merged id) of all pairs that merge."""
    return [(ranks[left], ranks[right], rank) for token, rank in ranks.items() for i in range(1, len(token))
            if (left := token[:i]) in ranks and (right := token[i:]) in ranks]


class Merger:
    """Ids of pre-tokens: a token of the file as it is, all others by merging pairs from single bytes on."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.pairs = PairMerger(_pairs(ranks))
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    def __call__(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as little-endian int32."""
        out = [_packed([self.ranks[w]]) if w in self.ranks else None for w in words]
        rest = [i for i, ids in enumerate(out) if ids is None]
        short = [i for i in rest if len(words[i]) <= LONGEST]
        for i, ids in zip(short, self.pairs([words[i] for i in short], self.byte, self.byte)):
            out[i] = ids
        for i in rest:
            if out[i] is None:
                out[i] = _merge_long(words[i], self.ranks)
        return out


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<i4").tobytes()


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> bytes:
    """A long pre-token, with a heap over a linked list, so that its cost stays near linear."""
    from heapq import heapify, heappop, heappush

    n = len(word)
    ends, back = list(range(1, n + 1)), list(range(-1, n - 1))  # a part is its start; ends[start], start of the part before
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapify(heap)
    while heap:
        _, a, b, end = heappop(heap)
        if ends[a] != b or b >= n or ends[b] != end:
            continue
        ends[a], ends[b] = end, -1
        if end < n:
            back[end] = a
            if (r := ranks.get(word[a:ends[end]])) is not None:
                heappush(heap, (r, a, end, ends[end]))
        if a and (r := ranks.get(word[back[a]:end])) is not None:
            heappush(heap, (r, back[a], a, end))
    ids, at = [], 0
    while at < n:
        ids.append(ranks[word[at:ends[at]]])
        at = ends[at]
    return _packed(ids)


class Cache:
    """Ids (little-endian int32) by pre-token; what a generation of CACHED entries has not met again is forgotten."""

    def __init__(self, merger: Callable[[list[bytes]], list[bytes]]):
        self.merger = merger
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def fill(self, words: Iterable[str]) -> dict[str, bytes]:
        """A dictionary that has all the words."""
        if len(self.new) > CACHED:
            self.new, self.old = {}, self.new
        fresh = set(words).difference(self.new)
        known = fresh.intersection(self.old)
        self.new.update((w, self.old[w]) for w in known)
        fresh = list(fresh - known)
        self.new.update(zip(fresh, self.merger([w.encode("utf-8") for w in fresh])))
        return self.new


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file: base64 of a token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@cache
def _worker(path: str) -> tuple[Cache, np.ndarray]:
    """What a Python worker keeps from task to task: merged pre-tokens, and the byte lengths of tokens."""
    ranks = read_ranks(path)
    lengths = np.zeros(max(ranks.values()) + 1, np.int32)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    return Cache(Merger(ranks)), lengths


def encode(docs: DataFrame, path: str, column: str = "text") -> DataFrame:
    """``docs`` with ``ids`` array<int> and ``offsets`` array<int> in place of the text column.

    offsets are the byte positions at which tokens begin in the UTF-8 text, and its length at the end. A null or empty
    text has no ids and the single offset 0. Texts are never cut; the file at ``path`` must be readable on every executor.
    """

    def make():
        cached, lengths = _worker(path)

        def step(texts):
            words = pre_tokens([t or "" for t in texts])
            merged = cached.fill(chain.from_iterable(words))
            ids = [b"".join(map(merged.__getitem__, w)) for w in words]
            flat = np.frombuffer(b"".join(ids), "<i4")
            cuts = np.concatenate([[0], np.cumsum([len(i) // 4 for i in ids])])
            ends = np.concatenate([[0], np.cumsum(lengths[flat])])
            starts = ends[cuts[:-1]]
            own = np.repeat(np.arange(len(ids)), np.diff(cuts) + 1)  # one offset more than ids
            offsets = ends[np.arange(len(own)) - own] - starts[own]
            many = cuts + np.arange(len(cuts))
            return [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat, pa.int32())),
                    pa.ListArray.from_arrays(pa.array(many, pa.int32()), pa.array(offsets, pa.int32()))]

        return step

    return map_steps(docs, column, make, "ids array<int>, offsets array<int>")


def decode(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` (ids, offsets, ...) with ``bytes`` binary in place of both: each token's bytes put at its offset."""
    kept = [f for f in rows.schema.fields if f.name not in ("ids", "offsets", "bytes")]
    small_batches(rows.sparkSession)
    schema = type(rows.schema)([*kept]).add("bytes", "binary")

    def run(batches):
        ranks = read_ranks(path)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        pool = np.frombuffer(b"".join(tokens), np.uint8)
        ends = np.cumsum([len(t) for t in tokens])
        first = ends - [len(t) for t in tokens]
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                out = []
                for ids, offsets in zip(part.column("ids"), part.column("offsets")):
                    ids = ids.values.to_numpy() if ids.is_valid else np.zeros(0, np.int32)
                    places = offsets.values.to_numpy()[:-1] if offsets.is_valid else ids
                    size = (ends - first)[ids]
                    shift = np.repeat(first[ids] - places, size)
                    out.append(pool[np.arange(len(shift)) + shift].tobytes())
                arrays = [part.column(f.name) for f in kept] + [pa.array(out, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return rows.mapInArrow(run, schema)
