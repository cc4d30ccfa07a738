"""Token ids of whole texts under a word-level BPE file, with a cache of pre-tokens."""

from __future__ import annotations

import json
import os
import re
from functools import cache
from itertools import chain
from string import ascii_lowercase

import numpy as np
import pyarrow as pa

from riskframe.llm.common import runs
from riskframe.llm.pair_merge import LONGEST, PairMerger

#: Pre-tokens kept in each of the two generations of a worker's cache.
CACHED = 120_000
#: Parts of a text whose ids are put together at once.
BLOCK = 200_000
# Texts of ASCII and Latin-1 letters alone are cut here as the file's normaliser and pre-tokeniser would.
_OTHER = re.compile("[^\x00-\x7fÀ-ÖØ-öø-ÿ]|<\\|")
_SPACE, _LETTER, _DIGIT, _SIGN = range(4)
# The kind of each Latin-1 character in lower case.
_KINDS = np.array([
    _SPACE if c in b" \t\n\v\f\r" else _DIGIT if chr(c) in "0123456789" else _LETTER if chr(c) in ascii_lowercase or c >= 0xDF and c != 0xF7
    else _SIGN for c in range(256)], np.uint8)
_LETTERS = frozenset(np.flatnonzero(_KINDS == _LETTER).tolist())  # first bytes of words that are letters; no text is among them


def _is_plain(text: str) -> bool:
    return "<|" not in text if text.isascii() else not _OTHER.search(text)


def _cut(texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct pre-tokens of plain texts, in Latin-1; the number of each pre-token in turn; how many lie before each text's end.

    A pre-token is a run of letters, one digit or a run of signs; a sign's run that begins with ' before s, t, re, ve, m, ll
    or d ends behind these letters.
    """
    raw = np.frombuffer("\n".join([*texts, "  "]).lower().encode("latin-1"), np.uint8)  # one can look two places ahead
    kind = _KINDS[raw]
    begins = kind == _DIGIT
    begins[0] |= kind[0] != _SPACE
    begins[1:] |= (kind[1:] != kind[:-1]) & (kind[1:] != _SPACE)
    quote = np.flatnonzero(begins & (raw == ord("'")))
    one, two = raw[quote + 1], raw[quote + 2]
    short = np.isin(one, list(b"stmd"))
    long = (two == ord("e")) & np.isin(one, list(b"rv")) | (one == ord("l")) & (two == ord("l"))
    begins[quote[short | long] + 1] = False
    for found, letters in ((quote[short], 1), (quote[long], 2)):
        behind = found + letters + 1
        begins[behind] |= kind[behind] == _LETTER
    solid = kind != _SPACE
    data = raw[solid]
    offsets = np.append(np.flatnonzero(begins[solid]), len(data)).astype(np.int32)
    parts = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    parts = parts.dictionary_encode()
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    distinct = parts.dictionary.to_numpy(zero_copy_only=False).tolist()  # to_pylist makes a scalar of each first
    return distinct, parts.indices.to_numpy(), np.searchsorted(np.flatnonzero(begins), ends)


def _words(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The same of words between ASCII white space, for any texts."""
    numbers: dict[str, int] = {}
    each = [[numbers.setdefault(w.decode("utf-8"), len(numbers)) for w in t.encode("utf-8").split()] for t in texts]
    return list(numbers), np.fromiter(chain.from_iterable(each), np.int64), np.cumsum([len(e) for e in each], dtype=np.int64)


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it prints, else the next one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (chr(256 + i) for i in range(256))
    return [chr(b) if b in prints else next(others) for b in range(256)]


class WordIds:
    """Ids as little-endian uint32 bytes; each part is encoded once and then looked up.

    Parts go through the library but for short words of lower-case letters, which are merged here by the same file's
    merges, many at once; that needs the ids to follow the order of the merges.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        ids, end = model["vocab"], model["end_of_word_suffix"] or ""
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        becomes = [ids[a + b] for a, b in merges]
        self.merger = None
        if all(a < b for a, b in zip(becomes, becomes[1:])):
            self.merger = PairMerger((ids[a], ids[b], c) for (a, b), c in zip(merges, becomes))
            letters = _byte_letters()
            self.inner, self.final = (np.array([ids[c + e] for c in letters], np.int64) for e in ("", end))
        self.new: dict[bytes | str, bytes] = {}
        self.old: dict[bytes | str, bytes] = {}

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        out = [b""] * len(texts)
        plain = [_is_plain(text or "") for text in texts]
        for cut, wanted in ((_cut, True), (_words, False)):
            places = [i for i, p in enumerate(plain) if p == wanted and texts[i]]
            if places:
                parts, numbers, ends = cut([texts[i] for i in places])
                for i, ids in zip(places, self._joined(self._ids(parts), numbers, ends)):
                    out[i] = ids
        return out

    @staticmethod
    def _joined(ids: list[bytes], numbers: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """Ids of the texts, whose parts have these ``numbers``, from the ids of the distinct parts."""
        pool = np.frombuffer(b"".join(ids), "<u4")
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first, behind = np.cumsum(sizes) - sizes, np.append(0, np.cumsum(sizes[numbers]))

        def block(some, a):
            shift = first[some] - behind[a:a + len(some)]
            return pool[np.arange(behind[a], behind[a + len(some)]) + np.repeat(shift, sizes[some])].tobytes()

        flat = b"".join([block(numbers[a:a + BLOCK], a) for a in range(0, len(numbers), BLOCK)])
        ends = (4 * behind[ends]).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def _ids(self, parts: list[bytes] | list[str]) -> list[bytes]:
        """The ids of each of the distinct parts: pre-tokens as Latin-1 bytes, other words as text."""
        if len(self.new) > CACHED:
            self.new, self.old = {}, self.new
        found = list(map(self.new.get, parts))
        missing = [i for i, ids in enumerate(found) if ids is None]
        before, rest = map(self.old.get, [parts[i] for i in missing]), []
        for i, ids in zip(missing, before):
            if ids is None:
                rest.append(i)
            else:
                found[i] = self.new[parts[i]] = ids
        for i, ids in zip(rest, self._encode([parts[i] for i in rest])):
            found[i] = self.new[parts[i]] = ids
        return found

    def _encode(self, parts: list[bytes] | list[str]) -> list[bytes]:
        out, short = [b""] * len(parts), []
        if self.merger is not None:
            short = [i for i, p in enumerate(parts) if len(p) <= LONGEST // 2 and p[0] in _LETTERS]
            words = [parts[i].decode("latin-1").encode("utf-8") for i in short]
            for i, ids in zip(short, self.merger(words, self.inner, self.final)):
                out[i] = ids
        for some in runs(sorted(set(range(len(parts))).difference(short)), 5_000):
            texts = [p if isinstance(p := parts[i], str) else p.decode("latin-1") for i in some]
            for i, encoding in zip(some, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                out[i] = b"".join([t.to_bytes(4, "little") for t in encoding.ids])
        return out


@cache
def word_ids(path: str) -> WordIds:
    """One per Python worker, kept from task to task."""
    return WordIds(path)
