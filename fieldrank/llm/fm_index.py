"""An FM-index over a sequence of small integers, with batched queries.

The Burrows-Wheeler transform is kept in a wavelet matrix, one bit vector with
rank counts per bit of the alphabet. Backward search runs all patterns of one
length at once; occurrences are located by walking back to sampled suffixes.
"""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


class _Bits:
    """A bit vector with rank: counts per 64-bit word, then within the word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate(([0], np.cumsum(counts)))
        self.zeros = len(bits) - int(self.before[-1])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones in [0, i)."""
        word = i >> 6
        mask = (_ONE << (i & 63).astype(np.uint64)) - _ONE
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & _ONE == _ONE


class _WaveletMatrix:
    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.levels: list[tuple[int, _Bits]] = []
        for level in range(max(1, (alphabet - 1).bit_length()) - 1, -1, -1):
            ones = (symbols >> level) & 1 == 1
            self.levels.append((level, _Bits(ones)))
            symbols = np.concatenate((symbols[~ones], symbols[ones]))
        # Where each symbol's run starts after the last level.
        every = np.arange(alphabet)
        self.start = self._down(every, np.zeros(alphabet, dtype=np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, bits in self.levels:
            ones = bits.rank(i)
            i = np.where((symbol >> level) & 1 == 1, bits.zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of the symbol in [0, i)."""
        return self._down(symbol, i) - self.start[symbol]

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at i and its rank there."""
        symbol = np.zeros(len(i), dtype=np.int64)
        for level, bits in self.levels:
            one, ones = bits.get(i), bits.rank(i)
            symbol |= one.astype(np.int64) << level
            i = np.where(one, bits.zeros + ones, i - ones)
        return symbol, i - self.start[symbol]


def suffix_array(symbols: np.ndarray, alphabet: int) -> np.ndarray:
    """Start positions of the suffixes in order, by doubling the sorted prefix.

    The last symbol must be the only 0. Suffixes that are already alone with
    their prefix are not sorted again.
    """
    n = len(symbols)
    bits = max(1, (alphabet - 1).bit_length())
    width = max(1, 62 // bits)
    key = np.zeros(n, dtype=np.int64)
    for i in range(min(width, n)):
        key[: n - i] += symbols[i:].astype(np.int64) << (bits * (width - 1 - i))
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    rank = np.empty(n, dtype=np.int64)
    # The rank of a group is the place of its first suffix.
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    while True:
        alone = new & np.concatenate((new[1:], [True]))
        spots = np.flatnonzero(~alone)
        if len(spots) == 0:
            return order
        members = order[spots]
        follow = members + width
        second = np.where(follow < n, rank[np.minimum(follow, n - 1)], -1)
        again = np.lexsort((second, rank[members]))
        members, second = members[again], second[again]
        order[spots] = members
        first = rank[members]
        fresh = np.concatenate(([True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])))
        new[spots] = fresh
        rank[members] = np.maximum.accumulate(np.where(fresh, spots, 0))
        width *= 2


class FMIndex:
    """Counts and finds patterns in ``symbols``, integers from 1 to alphabet - 1."""

    def __init__(self, symbols: np.ndarray, alphabet: int, sample: int = 8):
        text = np.concatenate((symbols.astype(np.int64), [0]))
        order = suffix_array(text, alphabet)
        self.size = len(text)
        self.smaller = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=alphabet))))
        self.bwt = _WaveletMatrix(text[order - 1], alphabet)
        sampled = order % sample == 0
        self.sampled, self.samples = _Bits(sampled), order[sampled]

    def _back(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self.smaller[symbol] + self.bwt.rank(symbol, i)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix range [low, high) of each pattern, a row of ``patterns``."""
        low = np.zeros(len(patterns), dtype=np.int64)
        high = np.full(len(patterns), self.size)
        alive = np.arange(len(patterns))
        for column in patterns.T[::-1]:
            symbol = column[alive]
            low[alive] = self._back(symbol, low[alive])
            high[alive] = self._back(symbol, high[alive])
            alive = alive[low[alive] < high[alive]]
            if len(alive) == 0:
                break
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows."""
        found = np.empty(len(rows), dtype=np.int64)
        open_, at, steps = np.arange(len(rows)), rows, 0
        while len(open_):
            done = self.sampled.get(at)
            found[open_[done]] = self.samples[self.sampled.rank(at[done])] + steps
            open_, at = open_[~done], at[~done]
            symbol, rank = self.bwt.access(at)
            at = self.smaller[symbol] + rank
            steps += 1
        return found

    def occurrences(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row number of the pattern and position of each occurrence."""
        low, high = self.search(patterns)
        counts = high - low
        which = np.repeat(np.arange(len(patterns)), counts)
        offsets = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
        return which, self.locate(low[which] + offsets)
