"""FM-index of a sequence of small integers: wavelet-tree ranks and sampled suffix positions, in numpy."""

from __future__ import annotations

import numpy as np


class WaveletTree:
    """Ranks of symbols in a sequence, one level of bits per bit of the alphabet (matrix layout)."""

    def __init__(self, sequence: np.ndarray, bits: int):
        self.bits, self.zeros, self.ones = bits, [], []
        rest = sequence
        for level in range(bits - 1, -1, -1):
            bit = (rest >> level) & 1
            ones = np.zeros(len(rest) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(rest) - int(ones[-1]))
            rest = np.concatenate([rest[bit == 0], rest[bit == 1]])

    def descend(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Where a prefix of each length in ``places`` ends among its symbol's block of the last level."""
        for level in range(self.bits):
            ones = self.ones[level][places]
            bit = (symbols >> (self.bits - 1 - level)) & 1
            places = np.where(bit == 1, self.zeros[level] + ones, places - ones)
        return places

    def at(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol at each row, and the row's place in the last level."""
        symbols = np.zeros(len(rows), np.int64)
        for level in range(self.bits):
            ones = self.ones[level][rows]
            bit = self.ones[level][rows + 1] - ones
            symbols = symbols * 2 + bit
            rows = np.where(bit == 1, self.zeros[level] + ones, rows - ones)
        return symbols, rows


def suffix_order(sequence: np.ndarray) -> np.ndarray:
    """Places of all suffixes in order; each 0 ends its suffix and is less than all later 0s.

    Ranks double their depth each round, and only suffixes that still share a rank are sorted again.
    """
    n = len(sequence)
    order = np.argsort(sequence, kind="stable")
    values = sequence[order]
    new = np.ones(n, bool)
    new[1:] = (values[1:] != values[:-1]) | (values[1:] == 0)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    tied = np.zeros(n, bool)  # by place in the order
    tied |= ~new
    tied[:-1] |= ~new[1:]
    depth = 1
    while tied.any():
        slots = np.flatnonzero(tied)
        places = order[slots]
        key = rank[places] * (n + 1) + rank[np.minimum(places + depth, n - 1)]
        by_key = np.argsort(key)
        key, places = key[by_key], places[by_key]
        order[slots] = places
        new = np.ones(len(slots), bool)
        new[1:] = key[1:] != key[:-1]
        rank[places] = np.maximum.accumulate(np.where(new, slots, 0))
        still = ~new
        still[:-1] |= ~new[1:]
        tied[slots] = still
        depth *= 2
    return order


class FMIndex:
    """Counts and locates phrases in a sequence over 1..2**bits-1, where 0 separates its parts.

    ``sequence`` starts and ends with 0; phrases hold no 0.
    """

    def __init__(self, sequence: np.ndarray, bits: int, sample: int = 8):
        order = suffix_order(sequence)
        self.n = len(sequence)
        self.tree = WaveletTree(sequence[order - 1], bits)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=1 << bits))])
        # Every ``sample``-th place is kept, and each part's first one, so a walk never crosses a 0.
        keep = (order % sample == 0) | (sequence[order - 1] == 0)
        self.kept_before = np.concatenate([[0], np.cumsum(keep)]).astype(np.int64)
        self.kept = order[keep]

    def _step(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        return self.first[symbols] + self.tree.descend(symbols, places) - self._block(symbols)

    def _block(self, symbols: np.ndarray) -> np.ndarray:
        """Where each symbol's block of the tree's last level begins."""
        return self.tree.descend(symbols, np.zeros(len(symbols), np.int64))

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, place) of every occurrence; row k of ``phrases`` has ``lengths[k]`` symbols, right-aligned."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.n, np.int64)
        active = np.arange(len(phrases))
        for step in range(phrases.shape[1]):
            active = active[(high[active] > low[active]) & (lengths[active] > step)]
            if not len(active):
                break
            symbols = phrases[active, phrases.shape[1] - 1 - step]
            low[active], high[active] = self._step(symbols, low[active]), self._step(symbols, high[active])
        sizes = np.where(lengths > 0, np.maximum(high - low, 0), 0)
        found = np.repeat(np.arange(len(phrases)), sizes)
        rows = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(low, sizes)
        return found, self._locate(rows)

    def _locate(self, rows: np.ndarray) -> np.ndarray:
        places = np.zeros(len(rows), np.int64)
        open_, walked = np.arange(len(rows)), 0
        while len(open_):
            at = self.kept_before[rows]
            done = self.kept_before[rows + 1] > at
            places[open_[done]] = self.kept[at[done]] + walked
            open_, rows = open_[~done], rows[~done]
            symbols, ends = self.tree.at(rows)
            rows = self.first[symbols] + ends - self._block(symbols)
            walked += 1
        return places
