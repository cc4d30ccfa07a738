"""Merging of symbol pairs in many short words at once."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

from riskframe.llm.common import runs

#: Symbols up to which a word is merged together with others of its length.
LONGEST = 40
_WIDTHS = (8, 12, 16, 24, LONGEST)


class PairMerger:
    """Each round joins every word's pair of lowest rank, the leftmost of equal ones; a pair's rank is the id it becomes.

    Pairs are found in a hash table of at least four places a pair; a pair whose place is taken stands in the next free one.
    """

    NONE = 1 << 40
    _FREE = -1 << 62

    def __init__(self, pairs: Iterable[tuple[int, int, int]]):
        """``pairs``: left id, right id, merged id; of a pair that comes more than once the smallest."""
        table = np.array(sorted((a << 32 | b, c) for a, b, c in pairs), np.int64).reshape(-1, 2)
        keys, first = np.unique(table[:, 0], return_index=True)
        self.bits = max(4 * len(keys), 16).bit_length()
        self.keys = np.full(1 << self.bits, self._FREE)
        self.ids = np.full(1 << self.bits, self.NONE)
        left, place = np.arange(len(keys)), self._place(keys)
        while len(left):
            some, winner = np.unique(place, return_index=True)
            winner = winner[self.keys[some] == self._FREE]
            self.keys[place[winner]] = keys[left[winner]]
            self.ids[place[winner]] = table[first[left[winner]], 1]
            lost = np.delete(np.arange(len(left)), winner)
            left, place = left[lost], self._next(place[lost])

    def _place(self, key: np.ndarray) -> np.ndarray:
        return (key ^ key >> 29) * 0x1E3779B97F4A7C15 >> 64 - self.bits & (1 << self.bits) - 1

    def _next(self, place: np.ndarray) -> np.ndarray:
        return place + 1 & (1 << self.bits) - 1

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id that each pair becomes, NONE if it does not merge; ids below 0 merge with nothing."""
        key = (left << 32 | right).ravel()
        place = self._place(key)
        held = self.keys[place]
        rank = np.where(held == key, self.ids[place], self.NONE)
        again = np.flatnonzero((held != key) & (held != self._FREE))
        place = place[again]
        while len(again):
            place = self._next(place)
            held = self.keys[place]
            same = held == key[again]
            rank[again[same]] = self.ids[place[same]]
            more = ~same & (held != self._FREE)
            again, place = again[more], place[more]
        return rank.reshape(left.shape)

    def __call__(self, words: list[bytes], inner: np.ndarray, final: np.ndarray) -> list[bytes]:
        """The ids of each word of at most LONGEST bytes, as little-endian int32.

        ``inner`` and ``final`` are the symbols of each byte, the latter at the end of a word.
        """
        out = [b""] * len(words)
        widths = np.searchsorted(_WIDTHS, np.fromiter(map(len, words), np.int64, len(words)))
        for i, width in enumerate(_WIDTHS):
            for places in runs(np.flatnonzero(widths == i).tolist(), 20_000):
                for place, ids in zip(places, self._together([words[j] for j in places], width, inner, final)):
                    out[place] = ids
        return out

    def _together(self, words: list[bytes], width: int, inner: np.ndarray, final: np.ndarray) -> list[bytes]:
        """A column is a word, a row a place in it; the row behind the last is what lies outside a word."""
        n = len(words)
        sizes = np.fromiter(map(len, words), np.int64, n)
        inside = np.arange(width) < sizes[:, None]
        raw = np.zeros((n, width), np.uint8)
        raw[inside] = np.frombuffer(b"".join(words), np.uint8)
        ids = np.full((width + 1, n), -1)
        ids[:-1] = np.where(inside, inner[raw], -1).T
        some = np.flatnonzero(sizes)
        ids[sizes[some] - 1, some] = final[raw[some, sizes[some] - 1]]
        ahead, back = np.empty((2, width + 1, n), np.int8)  # places of the symbols beside each
        ahead[:], back[:] = np.arange(1, width + 2)[:, None], np.arange(-1, width)[:, None]
        back[0] = width
        order = np.full((width + 1, n), self.NONE << 6)  # rank of the pair that begins here, then its place
        order[:width - 1] = self._rank(ids[:width - 1], ids[1:width]) << 6 | np.arange(width - 1)[:, None]
        while True:
            best = order[:width].min(axis=0)
            live = np.flatnonzero(best < self.NONE << 6)
            if not len(live):
                break
            low, at = best[live] >> 6, best[live] & 63
            gone = ahead[at, live]
            behind, before = ahead[gone, live], back[at, live]
            ids[at, live], ids[gone, live] = low, -1
            ahead[at, live], back[behind, live] = behind, at
            order[gone, live] = self.NONE << 6
            order[at, live] = self._rank(low, ids[behind, live]) << 6 | at
            order[before, live] = self._rank(ids[before, live], low) << 6 | before
        ids = np.ascontiguousarray(ids[:-1].T)
        ends = np.cumsum(4 * (ids >= 0).sum(axis=1)).tolist()
        flat = ids[ids >= 0].astype("<i4").tobytes()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]
