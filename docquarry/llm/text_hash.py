"""Words and shingles of many texts at once, as 64-bit hashes in numpy.

A batch of texts is one byte array. Words are found by comparing neighbouring bytes, and a word's
hash is a difference of prefix sums of a polynomial over random byte values, so nothing here runs
once per word in Python.  Two different words share a hash with a probability near 2**-60.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_ODD = lambda n: _RANDOM.integers(0, 2**64, n, dtype=np.uint64) | np.uint64(1)
_BYTE_VALUES = _ODD(256)
_BYTE_VALUES[65:91] = _BYTE_VALUES[97:123]  # A-Z count as a-z
_BASE = int(_ODD(1)[0])
_INVERSE = pow(_BASE, -1, 2**64)
_SHINGLE_FACTORS = _ODD(64)
CHUNK_BYTES = 1 << 20

#: Bytes that separate words: white space, or every ASCII character but letters and digits.
SPACES = np.zeros(256, bool)
SPACES[[0x20, 9, 10, 11, 12, 13]] = True
NOT_ALPHANUMERIC = np.zeros(256, bool)
NOT_ALPHANUMERIC[:128] = True
NOT_ALPHANUMERIC[48:58] = NOT_ALPHANUMERIC[65:91] = NOT_ALPHANUMERIC[97:123] = False


class _Powers:
    """Powers of the base and of its inverse, kept for the longest chunk so far."""

    up = down = np.ones(0, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            steps = np.full(n, _BASE, np.uint64)
            steps[0] = 1
            back = np.full(n, _INVERSE, np.uint64)
            back[0] = 1
            cls.up, cls.down = np.cumprod(steps, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)
        return cls.up, cls.down


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def chunks(texts: Iterable[str | None], size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """(first, last, encoded texts) of runs of texts of about ``size`` bytes; null is empty."""
    run, length, first, n = [], 0, 0, 0
    for n, text in enumerate(texts, 1):
        data = b"" if text is None else text.encode("utf-8", "surrogatepass")
        if run and length + len(data) > size:
            yield first, n - 1, run
            run, length, first = [], 0, n - 1
        run.append(data)
        length += len(data) + 1
    if run:
        yield first, n, run


def word_hashes(encoded: list[bytes], separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words' hashes in order, and for each text (and one past the last) its first word's place."""
    data = np.frombuffer(b"\n" + b"\n".join(encoded) + b"\n", np.uint8)
    gap = separators[data]
    edges = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    begin, end = edges[0::2], edges[1::2]
    up, down = _Powers.of(len(data))
    values = _BYTE_VALUES[data]
    values *= up[: len(data)]
    sums = np.cumsum(values, dtype=np.uint64)
    hashes = mixed((sums[end - 1] - sums[begin - 1]) * down[begin])
    starts = np.cumsum([1] + [len(x) + 1 for x in encoded])
    return hashes, np.searchsorted(begin, starts)


def shingle_sets(encoded: list[bytes], separators: np.ndarray = SPACES, width: int = 5) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``width`` words.

    A text with fewer words gives one shingle of all of them, one without words gives none.
    """
    words, places = word_hashes(encoded, separators)
    n = max(0, len(words) - width + 1)
    runs = np.zeros(n, np.uint64)
    for k in range(width):
        runs += words[k : k + n] * _SHINGLE_FACTORS[k]
    runs = mixed(runs)
    for a, b in zip(places[:-1].tolist(), places[1:].tolist()):
        if b - a >= width:
            found = np.sort(runs[a : b - width + 1])
            keep = np.empty(len(found), bool)
            keep[0] = True
            np.not_equal(found[1:], found[:-1], out=keep[1:])
            yield found[keep]
        elif b > a:
            # The number of words is part of the hash, so "a b" is no prefix of a longer shingle.
            yield mixed(np.array([(words[a:b] * _SHINGLE_FACTORS[: b - a]).sum() + np.uint64(b - a)], np.uint64))
        else:
            yield np.zeros(0, np.uint64)
