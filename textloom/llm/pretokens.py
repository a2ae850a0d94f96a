"""The pre-tokens of a byte-level tokenizer for whole Arrow chunks at once.

The pattern is the public one of the rank files: contractions, letters, digits and other marks with at most one
space in front, and white space. Its alternatives only depend on the kinds of neighbouring characters, so the
places where matches begin follow from comparisons of whole arrays.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

import numpy as np
import pandas as pd
import regex

from textloom.llm.arrays import prefix_hash, span_hash

LETTER, DIGIT, BLANK = 1, 2, 3
#: What may follow an apostrophe as one token.
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]


@cache
def _kinds() -> np.ndarray:
    """Kind of every code point: letter, digit, white space, or 0 for the rest."""
    kinds = np.zeros(0x110000, np.uint8)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    every = "".join(map(chr, points))
    for kind, pattern in ((LETTER, r"\p{L}"), (DIGIT, r"\p{N}"), (BLANK, r"\s")):
        kinds[[ord(c) for c in regex.findall(pattern, every)]] = kind
    return kinds


def pretoken_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions at which the pre-tokens of all rows begin; together they cover every byte."""
    if not len(data):
        return np.zeros(0, np.int64)
    lead = np.flatnonzero((data & 0xC0) != 0x80)  # first byte of each code point
    ascii_only = len(lead) == len(data)
    points = data.astype(np.uint32) if ascii_only else np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    kind = _kinds()[points]
    n = len(points)
    row = np.zeros(n + 1, bool)  # where a row begins
    row[np.searchsorted(lead, offsets)] = True
    row[n] = True
    before = np.roll(kind, 1)
    blank = kind == BLANK
    change = kind != before
    change |= row[:n]
    # a plain space belongs to what follows it
    joined = np.zeros(n, bool)
    joined[1:] = (points[:-1] == 0x20) & ~blank[1:] & ~row[1:n]
    start = change & ~joined
    # the last of several white-space characters before something else stands alone, or goes with it
    last = np.zeros(n, bool)
    last[:-1] = blank[:-1] & ~blank[1:] & ~row[1:n]
    start |= last
    _contractions(points, row, start)
    return lead[start]


def _contractions(points: np.ndarray, row: np.ndarray, start: np.ndarray) -> None:
    n = len(points)
    quotes = np.flatnonzero((points == 0x27) & start)
    for tail in CONTRACTIONS:
        fits = quotes[quotes + len(tail) < n]
        for j, c in enumerate(tail):
            fits = fits[(points[fits + 1 + j] == ord(c)) & ~row[fits + 1 + j]]
        for j in range(len(tail)):
            start[fits + 1 + j] = False
        after = fits + 1 + len(tail)
        start[after[after < n]] = True


def distinct_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """Number of each pre-token in a list of the chunk's distinct words, the list, the words' hashes, and the
    first pre-token of each row (rows + 1)."""
    starts = pretoken_starts(data, offsets)
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    hashes = span_hash(prefix_hash(data), starts, ends)
    codes, found = pd.factorize(hashes)
    first = np.zeros(len(found), np.int64)
    first[codes[::-1]] = np.arange(len(codes))[::-1]
    raw = data.tobytes()
    return codes, [raw[a:b] for a, b in zip(starts[first], ends[first], strict=True)], found, np.searchsorted(starts, offsets)


def gather(codes: np.ndarray, lengths: np.ndarray, begins: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of all codes one after the other, and where each code's values begin (codes + 1).

    `values[begins[c] : begins[c] + lengths[c]]` belong to code `c`.
    """
    size = lengths[codes]
    at = np.concatenate([[0], np.cumsum(size)])
    index = np.repeat(begins[codes] - at[:-1], size) + np.arange(at[-1])
    return values[index], at


class WordEncoder:
    """Ids of the texts of a chunk, where each distinct word is encoded once; keeps a bounded number of words."""

    def __init__(self, encode: Callable[[list[bytes]], list[list[int]]], keep: int = 400_000):
        self.encode, self.keep = encode, keep
        self._known: dict[int, tuple[int, int]] = {}
        self._ids, self._used = np.zeros(1 << 16, np.int32), 0

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other, and where each row's begin (rows + 1)."""
        codes, words, hashes, first = distinct_words(data, offsets)
        if len(self._known) > self.keep:
            self._known, self._used = {}, 0
        keys = hashes.tolist()
        new = [i for i, h in enumerate(keys) if h not in self._known]
        for i, ids in zip(new, self.encode([words[i] for i in new]), strict=True):
            while self._used + len(ids) > len(self._ids):
                self._ids = np.concatenate([self._ids, np.zeros_like(self._ids)])
            self._ids[self._used : self._used + len(ids)] = ids
            self._known[keys[i]] = (self._used, len(ids))
            self._used += len(ids)
        place = np.array([self._known[h] for h in keys], np.int64).reshape(-1, 2)
        ids, at = gather(codes, place[:, 1], place[:, 0], self._ids)
        return ids, at[first]
