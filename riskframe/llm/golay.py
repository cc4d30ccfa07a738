"""The binary [23, 12, 7] Golay code: indices of the codewords near a 23-bit word.

The code is perfect: every word is within 3 bits of one codeword. Words at most 2 bits apart have a common codeword
within 4 bits of both (the one nearest to the word between them), and no word has more than 6 codewords that near.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

#: Fixed value: the generator x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
MOST_KEYS = 6


def parity(message: np.ndarray) -> np.ndarray:
    """The 11 check bits of 12-bit messages: message * x^11 modulo the generator."""
    rest = message.astype(np.int64) << 11
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - 11)), rest)
    return rest


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Check bits by message; for each syndrome, what turns a word's message into its near codewords', and how many."""
    checks = parity(np.arange(4096))
    words = np.arange(4096) << 11 | checks
    weight = np.bitwise_count(words)
    seven = words[weight == 7]
    masks, many = np.zeros((2048, MOST_KEYS), np.int64), np.ones(2048, np.int64)
    for errors in range(4):
        for places in combinations(range(23), errors):
            error = sum(1 << p for p in places)
            syndrome = (error & 2047) ^ checks[error >> 11]
            masks[syndrome, 0] = error >> 11
            if errors == 3:  # words of weight 7 over these three places lie 4 bits from the word
                over = seven[seven & error == error]
                masks[syndrome, 1:1 + len(over)] = (error >> 11) ^ (over >> 11)
                many[syndrome] = 1 + len(over)
    return checks, masks, many


def near_codewords(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the codewords within 4 bits of each word, in MOST_KEYS columns, and how many of the columns count."""
    checks, masks, many = _tables()
    words = words.astype(np.int64)
    syndrome = (words & 2047) ^ checks[words >> 11]
    return (words >> 11)[:, None] ^ masks[syndrome], many[syndrome]
