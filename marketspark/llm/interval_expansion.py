"""Which strings of a given length occur more than once in some texts: bounded interval expansion on a Burrows-Wheeler
transform.

An interval is the range of sorted suffixes that begin with one string. Starting with the symbols, every interval is
extended backwards by each symbol that precedes its suffixes, which gives the intervals of strings one symbol longer.
Breadth-first, the end of a new interval is a border between suffixes whose common prefix has exactly the length of the
string extended; borders are therefore found by increasing length, and an interval whose end is a known border need not be
extended. After ``length`` levels the suffixes between two borders share that many symbols, and no common prefix
of that length or more was ever computed.

All intervals of a level go through the transform together: those of one suffix by its mapping, larger ones down a wavelet
matrix, where they split by bits until each part holds one symbol.
"""

import numpy as np

from marketspark.llm.fm_index import WaveletMatrix


def sorted_suffixes(symbols: np.ndarray, length: int) -> np.ndarray:
    """The suffixes in the order of their first ``length`` symbols or more. 0 ends a text; ends differ, in their order.

    The first order is by eight symbols; then the length doubles and only suffixes with equals are sorted anew.
    """
    n = len(symbols)
    ends = np.flatnonzero(symbols == 0)
    key = np.zeros(n, dtype=np.uint64)
    wide = np.zeros(n + 8, dtype=np.uint64)
    wide[:n] = symbols
    # Nine bits a symbol would not fit eight of them: seven symbols, then the ends are told apart.
    for step in range(7):
        key = (key << np.uint64(9)) | wide[step : step + n]
    # Behind an end nothing may count.
    stop = np.searchsorted(ends, np.arange(n))
    distance = ends[np.minimum(stop, len(ends) - 1)] - np.arange(n)
    near = distance < 7
    shift = (np.uint64(9) * (np.uint64(6) - distance[near].astype(np.uint64))).astype(np.uint64)
    key[near] = (key[near] >> shift) << shift
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    fresh = np.ones(n, dtype=bool)
    # Suffixes that reach an end within the key differ from all others; the order of the ends is that of their places.
    fresh[1:] = (ordered[1:] != ordered[:-1]) | near[order[1:]]
    rank = np.empty(n, dtype=np.int64)
    slot = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank[order] = slot
    step = 7
    while step < length:
        alone = fresh & np.append(fresh[1:], True)
        open_slots = np.flatnonzero(~alone)
        if not len(open_slots):
            break
        sub = order[open_slots]
        key = rank[sub] * (n + 1) + rank[np.minimum(sub + step, n - 1)]
        turn = np.argsort(key, kind="stable")
        order[open_slots] = sub[turn]
        key = key[turn]
        new = np.ones(len(key), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        fresh[open_slots] |= new
        heads = np.maximum.accumulate(np.where(fresh[open_slots], open_slots, 0))
        rank[order[open_slots]] = heads
        step *= 2
    return order


class Transform:
    def __init__(self, symbols: np.ndarray, order: np.ndarray, size: int):
        self.n = len(symbols)
        self.size = size
        before = symbols[order - 1]
        self.before = before
        counts = np.bincount(symbols, minlength=size)
        self.smaller = np.concatenate([[0], np.cumsum(counts)])
        # Where a suffix goes when the symbol before it is put in front.
        self.mapping = np.empty(self.n, dtype=np.int32)
        self.mapping[np.argsort(before, kind="stable")] = np.arange(self.n, dtype=np.int32)
        self.matrix = WaveletMatrix(before, size)

    def extended(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of all strings one symbol longer, without those that would begin with an end."""
        single = high - low == 1
        at = low[single]
        at = at[self.before[at] != 0]
        alone = self.mapping[at].astype(np.int64)
        low, high = low[~single], high[~single]
        symbol = np.zeros(len(low), dtype=np.int64)
        for bits in self.matrix.levels:
            ones_low, ones_high = bits.ones(low), bits.ones(high)
            zero_low, zero_high = low - ones_low, high - ones_high
            left, right = zero_high > zero_low, ones_high > ones_low
            low = np.concatenate([zero_low[left], bits.zeros + ones_low[right]])
            high = np.concatenate([zero_high[left], bits.zeros + ones_high[right]])
            symbol = np.concatenate([symbol[left] << 1, (symbol[right] << 1) | 1])
        real = symbol != 0
        low, high, symbol = low[real], high[real], symbol[real]
        base = self.smaller[symbol] - self.matrix.first[symbol]
        return np.concatenate([alone, base + low]), np.concatenate([alone + 1, base + high])


def borders(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each place of the suffix order and the one behind the last: whether the suffix there shares fewer than
    ``length`` symbols with the one before it."""
    n = len(symbols)
    size = int(symbols.max(initial=0)) + 1
    found = np.zeros(n + 1, dtype=bool)
    found[[0, n]] = True
    transform = Transform(symbols, order, size)
    ends = int(transform.smaller[1])
    # The ends are symbols of their own, the others one interval each: strings of one symbol, common prefixes of none.
    low = np.concatenate([np.arange(ends), transform.smaller[1:-1]])
    high = np.concatenate([np.arange(1, ends + 1), transform.smaller[2:]])
    for _ in range(length):
        fresh = (high > low) & ~found[high]
        low, high = low[fresh], high[fresh]
        found[high] = True
        if not len(low):
            break
        low, high = transform.extended(low, high)
    return found


def repeated(symbols: np.ndarray, weights: np.ndarray, length: int) -> np.ndarray:
    """For every place of ``symbols`` whether the ``length`` symbols from there on occur with a total weight of two or more.

    ``symbols`` holds texts of symbols from 1 on, each with a 0 behind it; ``weights`` has how often the text of a place
    occurs. Strings that would reach beyond their text's end are not repeated.
    """
    n = len(symbols)
    result = np.zeros(n, dtype=bool)
    if not n:
        return result
    order = sorted_suffixes(symbols, length)
    first = np.flatnonzero(borders(symbols, order, length)[:-1])
    sums = np.add.reduceat(weights[order], first)
    result[order] = np.repeat(sums >= 2, np.diff(np.append(first, n)))
    ends = np.flatnonzero(symbols == 0)
    left = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)
    return result & (left >= length)
