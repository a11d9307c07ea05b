"""Words of a batch of texts as 64-bit hashes, in numpy.

A word is a run of anything but ASCII white space. Its hash is a polynomial over its bytes
modulo 2**64, finished by a bijective mix; all words of a batch are hashed together from prefix sums.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[*b"\t\n\v\f\r "]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_CHUNK = 1 << 20
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def spans(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end byte of every word, and the number of words before each text (one more than texts)."""
    word = ~_SPACE[raw]
    begins, stops = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    stops[:-1] &= ~word[1:]
    inner = ends[(ends > 0) & (ends < len(raw))]
    begins[inner] = word[inner]
    stops[inner - 1] = word[inner - 1]
    begin, stop = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return begin, stop, np.searchsorted(begin, ends)


def hashes(raw: np.ndarray, begin: np.ndarray, stop: np.ndarray, lower: bool = False) -> np.ndarray:
    """The hash of each word; ASCII letters count as lower case if asked."""
    out = np.zeros(len(begin), np.uint64)
    inverse = pow(_BASE, -1, 1 << 64)
    first = 0
    while first < len(begin):  # in chunks, so that memory follows the chunk and not the text
        last = max(first + 1, int(np.searchsorted(stop, begin[first] + _CHUNK, side="right")))
        low, high = begin[first], stop[last - 1]
        part = raw[low:high]
        n = max(_CHUNK, high - low)
        values = _BYTE[_LOWER[part] if lower else part] * _powers(_BASE, n)[: high - low]
        total = np.zeros(high - low + 1, np.uint64)
        np.cumsum(values, out=total[1:])
        b, s = begin[first:last] - low, stop[first:last] - low
        out[first:last] = (total[s] - total[b]) * _powers(inverse, n)[b] + (s - b).astype(np.uint64)
        first = last
    return mix(out)


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """The hash of the k words from each word on (len(words) - k + 1 of them), texts not regarded."""
    n = max(0, len(words) - k + 1)
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out = mix(out * np.uint64(0x2545F4914F6CDD1D) + words[j : j + n])
    return out
