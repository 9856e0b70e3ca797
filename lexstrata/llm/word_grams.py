"""Hashed word n-grams of documents: of the words themselves and of their shapes (case, ending, digits, repetition)."""

from __future__ import annotations

import numpy as np

from .common import LOWER, Slice, SpanHash, chained, mixed, words


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_UPPER = _table(bytes(range(65, 91)))
_LOWER = _table(bytes(range(97, 123)))
_LETTER = _UPPER | _LOWER
_LETTER[128:] = True
_DIGIT = _table(b"0123456789")
_STOP = _table(b".,;:?")
_LENGTHS = np.array([2, 4, 8, 13, 21])


def _count(mask: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int32)
    np.cumsum(mask, out=total[1:], dtype=np.int32)
    return total[end] - total[start]


def shapes(s: Slice, start: np.ndarray, end: np.ndarray, repeated: np.ndarray) -> np.ndarray:
    """A small number for each word: its case, last characters, digits, length class, and whether it repeats the word before it."""
    d = s.data
    upper, lower, digit = (_count(t[d], start, end) for t in (_UPPER, _LOWER, _DIGIT))
    case = np.where(upper == 0, 0, np.where((lower == 0) & (upper > 1), 2, np.where((upper == 1) & _UPPER[d[start]], 1, 3)))
    last, before = d[end - 1], d[np.maximum(end - 2, start)]
    ending = np.where(_LETTER[last], 0, np.where(_STOP[last], 1, np.where((last == before) & (end - start > 1), 2, 3)))
    letters = _count(_LETTER[d], start, end) > 0
    length = np.searchsorted(_LENGTHS, end - start, "right")
    return ((((case * 4 + ending) * 2 + (digit > 0)) * 2 + letters) * 6 + length) * 2 + repeated


def grams(s: Slice, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(document in the slice, bucket) of each n-gram: words and pairs of words in lower case, and shapes by one, two
    and three. Grams do not cross documents."""
    start, end, doc = words(s)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = SpanHash(LOWER[s.data])(start, end)
    repeated = np.zeros(len(h), bool)
    repeated[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    shape = mixed(shapes(s, start, end, repeated).astype(np.uint64) + np.uint64(1 << 20))
    docs, out = [], []
    for values, most in ((h, 2), (shape, 3)):
        for n in range(1, most + 1):
            g = values if n == 1 else chained(values, n)
            if n > 1:
                inside = doc[n - 1 :] == doc[: len(doc) - n + 1]
                out.append(g[inside])
                docs.append(doc[: len(g)][inside])
            else:
                out.append(g)
                docs.append(doc)
    return np.concatenate(docs), (np.concatenate(out) >> np.uint64(64 - bits)).astype(np.int64)
