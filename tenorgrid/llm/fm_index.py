"""A compressed FM-index over word symbols: suffix order, wavelet matrix of bit-packed levels, backward search."""

from __future__ import annotations

import numpy as np

ONE = np.uint64(1)


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols, by prefix doubling; the text is taken as a ring."""
    _, rank = np.unique(text, return_inverse=True)
    rank = rank.astype(np.int64)
    n, h = len(text), 1
    while True:
        order = np.argsort(rank * n + np.roll(rank, -h), kind="stable")
        key = (rank * n + np.roll(rank, -h))[order]
        fresh = np.empty(n, np.int64)
        fresh[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        rank, h = fresh, h * 2
        if h >= depth or rank.max() == n - 1:
            return np.argsort(rank, kind="stable")


class WaveletMatrix:
    """Counts of a symbol before a place, one packed bit vector with a count per 64 places for each level."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels = max(1, int(size - 1).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        now, n = symbols, len(symbols)
        for shift in range(self.levels - 1, -1, -1):
            bit = ((now >> shift) & 1).astype(np.uint8)
            padded = np.zeros((n // 64 + 1) * 64, np.uint8)
            padded[:n] = bit
            packed = np.packbits(padded, bitorder="little").view(np.uint64)
            self.words.append(packed)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed))[:-1]]).astype(np.int64))
            self.zeros.append(n - int(bit.sum()))
            now = np.concatenate([now[bit == 0], now[bit == 1]])
        self.base = np.zeros(size, np.int64)
        self.base = self.rank(np.arange(size), np.zeros(size, np.int64))

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        i = place
        for level, shift in enumerate(range(self.levels - 1, -1, -1)):
            block = i >> 6
            below = (ONE << (i & 63).astype(np.uint64)) - ONE
            ones = self.counts[level][block] + np.bitwise_count(self.words[level][block] & below)
            i = np.where((symbol >> shift) & 1, self.zeros[level] + ones, i - ones)
        return i - self.base[symbol]


class FmIndex:
    """Index of segments of symbols (1 and up), which a separator 0 keeps apart."""

    def __init__(self, text: np.ndarray, size: int, depth: int):
        order = suffix_order(text, depth)
        self.n = len(text)
        self.wavelet = WaveletMatrix(text[order - 1], size)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))])[:size]

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Interval of ``symbol`` followed by what has the interval ``low : high``."""
        both = self.wavelet.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        first = self.before[symbol]
        return first + both[: len(symbol)], first + both[len(symbol):]


def repeated_windows(segments: np.ndarray, start: np.ndarray, count: np.ndarray, width: int) -> np.ndarray:
    """Bit w of a segment's mask is set if its window of ``width`` words at w occurs again in any of the segments.

    ``segments`` holds the word hashes of all segments, one after the other; segment k starts at ``start[k]`` and has
    ``count[k]`` windows (at most 62). A window is searched from its end: where the matching interval falls below two
    suffixes, every window over that place is settled at once. After a repeated window the end of the segment is
    extended to the left as far as it matches, which settles the run of windows up to there.
    """
    k = len(start)
    length = count + width - 1
    _, symbols = np.unique(segments, return_inverse=True)
    size = int(symbols.max()) + 2
    text = np.zeros(len(segments) + k, np.int64)
    at = start + np.arange(k)  # each segment is followed by its separator
    text[np.arange(len(segments)) + np.repeat(np.arange(k), length)] = symbols + 1
    index = FmIndex(text, size, int(length.max()))

    mask = np.zeros(k, np.int64)
    lane = np.arange(k)
    window, top = np.zeros(k, np.int64), count.astype(np.int64).copy()
    tail = np.zeros(k, bool)
    j = window + width - 1
    low, high = np.zeros(k, np.int64), np.full(k, index.n, np.int64)
    while len(lane):
        low, high = index.extend(text[at[lane] + j], low, high)
        alive = high - low >= 2
        hit = alive & ~tail & (j == window)
        whole = alive & tail & (j == window)
        stuck = ~alive
        # a window is repeated: settle the run from the segment's end next
        mask[lane[hit]] |= np.int64(1) << window[hit]
        # the end matches down to the next window: all up to the end are repeated
        mask[lane[whole]] |= (np.int64(1) << top[whole]) - (np.int64(1) << window[whole])
        fail_tail = stuck & tail
        found = j + 1
        run = fail_tail & (found < top)
        mask[lane[run]] |= (np.int64(1) << top[run]) - (np.int64(1) << found[run])
        top = np.where(fail_tail, np.where(found < top, found, top - 1), top)
        window = np.where(hit, window + 1, np.where(stuck & ~tail, found, window))
        restart = hit | stuck
        tail = np.where(hit, True, np.where(stuck, False, tail))
        j = np.where(restart, np.where(tail, top, window + 1) + width - 2, j - 1)
        low, high = np.where(restart, 0, low), np.where(restart, index.n, high)
        stay = ~whole & (window < top)
        lane, window, top, tail, j, low, high = (x[stay] for x in (lane, window, top, tail, j, low, high))
    return mask
