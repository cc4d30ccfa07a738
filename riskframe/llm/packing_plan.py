"""Packing by counts of lengths: configuration linear program, multiplicative weights, rounding.

Everything here depends on the length histogram alone (at most ``capacity`` entries), never on the number of pieces.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Rounds of pricing, the share of the remaining demand that a round may use up, and how strongly covered lengths cheapen.
ROUNDS, STEP, RATE = 600, 0.75, 0.3
#: First weights are (length / capacity) to this power: long pieces are worth more than their share, as they fit worse.
POWER = 1.3


@dataclass
class Plan:
    """Blocks of slots by (length, first rank): ``each`` slots in every one of a row of sequences."""

    key: np.ndarray
    first: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces with these lengths and ranks among their length."""
        at = np.searchsorted(self.key, _key(length, rank), side="right") - 1
        replica, slot = np.divmod(rank - self.first[at], self.each[at])
        return self.sequence[at] + replica, self.offset[at] + slot * length


def _key(length, rank):
    return (length << 44) + rank


def best_filling(price: np.ndarray, capacity: int) -> dict[int, int]:
    """The unbounded knapsack's best filling {length: times}; price[l] is a length's value, -inf if it has no pieces."""
    value, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    price = price.copy()
    price[1] = max(price[1], 0.0)  # a token may stay unused
    for room in range(1, capacity + 1):
        gain = value[room - 1::-1] if room > 1 else value[:1]
        gain = gain[:room] + price[1:room + 1]
        best = int(gain.argmax())
        value[room], choice[room] = gain[best], best + 1
    filling: dict[int, int] = {}
    room = capacity
    while room > 0:
        length = int(choice[room])
        filling[length] = filling.get(length, 0) + 1
        room -= length
    return filling


def fractional(counts: np.ndarray, capacity: int) -> list[tuple[float, dict[int, int]]]:
    """Configurations and how often each is used, in fractions; together they cover no length more than wanted.

    Each length has a weight, lowered exponentially as it is covered. A round prices the best
    configuration under the weights by a knapsack dynamic program and uses it for part of what is left of its lengths.
    """
    left = counts.astype(float)
    lengths = np.arange(capacity + 1) / capacity
    used: list[tuple[float, dict[int, int]]] = []
    for _ in range(ROUNDS):
        open_ = left >= 1
        if not open_.any() or left @ lengths < 1:
            break
        covered = 1 - left / np.maximum(counts, 1)
        price = np.where(open_, lengths ** POWER * np.exp(-RATE * (covered - covered[open_].mean())), -np.inf)
        filling = {l: n for l, n in best_filling(price, capacity).items() if open_[l]}
        times = min(left[l] / n for l, n in filling.items())
        times = times if times < 2 else times * STEP
        for l, n in filling.items():
            left[l] -= times * n
        used.append((times, filling))
    return used


def plan(counts: np.ndarray, capacity: int) -> Plan:
    """Rounds the fractional uses down; what then remains goes best-fit, longest first, into open gaps and new sequences."""
    merged: dict[tuple, float] = {}
    for times, filling in fractional(counts, capacity):
        name = tuple(sorted(filling.items(), reverse=True))
        merged[name] = merged.get(name, 0.0) + times
    left = counts.astype(np.int64).copy()
    bins: list[list[tuple[int, tuple]]] = [[] for _ in range(capacity + 1)]  # by gap: (sequences, contents)
    for contents, times in merged.items():
        n = min(int(times + 1e-9), *(int(left[l]) // k for l, k in contents))
        if n > 0:
            bins[capacity - sum(l * k for l, k in contents)].append((n, contents))
            for l, k in contents:
                left[l] -= n * k
    gaps = np.array([bool(b) for b in bins])
    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            fits = np.flatnonzero(gaps[length:])
            if not len(fits):
                bins[capacity].append((n, ()))
                gaps[capacity] = True
                continue
            gap = length + int(fits[0])
            many, contents = bins[gap].pop()
            each = min(gap // length, n)
            used = min(many, n // each)
            rest = gap - each * length
            if many > used:
                bins[gap].append((many - used, contents))
            bins[rest].append((used, (*contents, (length, each))))
            gaps[gap], gaps[rest] = bool(bins[gap]), True
            n -= used * each
    return _blocks([b for group in bins for b in group if b[1]])


def _blocks(groups: list[tuple[int, tuple]]) -> Plan:
    rows, sequence, taken = [], 0, {}
    for many, contents in groups:
        offset = 0
        for length, each in contents:
            rank = taken.get(length, 0)
            rows.append((length, rank, each, sequence, offset))
            taken[length] = rank + many * each
            offset += length * each
        sequence += many
    table = np.array(rows, np.int64).reshape(-1, 5)
    table = table[np.argsort(_key(table[:, 0], table[:, 1]))]
    return Plan(_key(table[:, 0], table[:, 1]), *(table[:, i].copy() for i in range(1, 5)), sequence)
