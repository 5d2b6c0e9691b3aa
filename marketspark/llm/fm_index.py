"""A compressed full-text index over sequences of numbers: the Burrows-Wheeler transform of several short texts
in a wavelet matrix, searched backwards for many patterns at once."""

import numpy as np


class Bits:
    """A bit vector with rank, packed into 64-bit words and a count for each word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, dtype=np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.zeros(len(self.words), dtype=np.int32)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])
        self.zeros = len(bits) - int(bits.sum())

    def ones(self, places: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = places >> 6
        under = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & under)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, size: int):
        self.depth = max(1, int(size - 1).bit_length())
        self.levels = []
        for bit in reversed(range(self.depth)):
            ones = (symbols >> bit) & 1 == 1
            self.levels.append(Bits(ones))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        every = np.arange(size)
        self.first = self._down(every, np.zeros(size, dtype=np.int64))

    def _down(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        for level, bits in enumerate(self.levels):
            one = (symbols >> (self.depth - 1 - level)) & 1 == 1
            ones = bits.ones(places)
            places = np.where(one, bits.zeros + ones, places - ones)
        return places

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place."""
        return self._down(symbols, places) - self.first[symbols]


class Index:
    """Over texts of symbols from 1 on, one behind the other in ``symbols`` with a 0 behind each."""

    def __init__(self, symbols: np.ndarray):
        self.suffixes = _suffixes(symbols)
        size = int(symbols.max()) + 1
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=size))])
        self.matrix = WaveletMatrix(symbols[self.suffixes - 1], size)
        self.length = len(symbols)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that begin with each pattern (a row): backward search, all patterns in step."""
        low = np.zeros(len(patterns), dtype=np.int64)
        high = np.full(len(patterns), self.length, dtype=np.int64)
        for column in reversed(range(patterns.shape[1])):
            symbols = patterns[:, column]
            # Both ends go down the matrix together.
            ranks = self.matrix.rank(np.concatenate([symbols, symbols]), np.concatenate([low, high]))
            base = self.smaller[symbols]
            low, high = base + ranks[: len(symbols)], base + ranks[len(symbols) :]
        return low, high


def _suffixes(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling. The ends of texts differ, in the order of the texts."""
    n = len(symbols)
    ends = np.flatnonzero(symbols == 0)
    rank = symbols.astype(np.int64) + len(ends)
    rank[ends] = np.arange(len(ends))
    rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        ahead = np.zeros(n, dtype=np.int64)
        ahead[: max(n - step, 0)] = rank[step:] + 1
        key = rank * (n + 1) + ahead
        order = np.argsort(key, kind="stable")
        fresh = np.ones(n, dtype=np.int64)
        fresh[1:] = key[order[1:]] != key[order[:-1]]
        rank[order] = np.cumsum(fresh) - 1
        if rank[order[-1]] == n - 1:
            return order
        step *= 2
