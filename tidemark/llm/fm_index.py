"""A compressed FM-index over word numbers in numpy: bit-packed wavelet matrix, capped matching statistics."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector with rank: 64-bit words and a count before each."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)[:-1])).astype(np.int32)
        self.ones = int(np.count_nonzero(bits))

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        at = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at] + np.bitwise_count(self.words[at] & mask)


class WaveletMatrix:
    """Rank of any symbol; levels of bits from the highest, zeros before ones."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.size, self.levels = len(symbols), max(1, int(sigma - 1).bit_length())
        self.bits, self.zeros = [], []
        for k in range(self.levels - 1, -1, -1):
            b = ((symbols >> k) & 1).astype(np.uint8)
            self.bits.append(Bits(b))
            self.zeros.append(len(symbols) - self.bits[-1].ones)
            symbols = np.concatenate((symbols[b == 0], symbols[b == 1]))
        self.first = self._walk(np.arange(sigma), np.zeros(sigma, np.int64))

    def _walk(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, (bits, zeros) in enumerate(zip(self.bits, self.zeros, strict=True)):
            ones = bits.rank(i)
            i = np.where((symbol >> (self.levels - 1 - level)) & 1, zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often symbol stands before position i."""
        return self._walk(symbol, i) - self.first[symbol]


class FmIndex:
    """Of texts of word numbers from 1 to sigma - 1, each followed by the separator 0.

    Suffixes are ordered by their first 16 words, which is all that patterns of up to `cap` <= 15 words need.
    """

    def __init__(self, words: np.ndarray, sigma: int, cap: int):
        assert 1 <= cap <= 15
        self.cap, self.size, self.sigma = cap, len(words), sigma
        n = len(words)
        rank = words.astype(np.int64)
        self._ranks = {1: rank}
        for step in (1, 2, 4, 8):
            after = np.zeros(n, np.int64)
            after[: n - step] = rank[step:] + 1 if n > step else 0
            key = rank * (max(n, sigma) + 2) + after
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.concatenate(([0], ordered[1:] != ordered[:-1]))) if n else 0
            self._ranks[2 * step] = rank
        self.suffix = order
        self.matrix = WaveletMatrix(words[order - 1].astype(np.int64), sigma)  # what stands before each suffix
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(words, minlength=sigma))))
        self._edges: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _parents(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """First and end of each suffix's run of suffixes that share its first `depth` words."""
        if depth not in self._edges:
            differs, at = np.zeros(self.size, bool), 0
            for step in (8, 4, 2, 1):
                if depth & step:
                    r = np.full(self.size, -1, np.int64)
                    r[: self.size - at] = self._ranks[step][at:]
                    r = r[self.suffix]
                    differs[1:] |= r[1:] != r[:-1]
                    at += step
            differs[:1] = True
            heads = np.flatnonzero(differs)
            run = np.cumsum(differs) - 1
            self._edges[depth] = heads[run].astype(np.int32), np.append(heads[1:], self.size)[run].astype(np.int32)
        return self._edges[depth]

    def matching_statistics(self, words: np.ndarray, first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each position of the given documents in `words`: how many words from there on, `cap` at most, occur
        in the index, and their interval of suffixes. Word numbers that the index lacks are -1.

        Backward search from the last word of every document at once; where a longer match fails, or would pass the
        cap, the interval is widened to that of fewer words.
        """
        size, low, high = np.zeros(len(words), np.int32), np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        lo, hi, have = np.zeros(len(first), np.int64), np.full(len(first), self.size, np.int64), np.zeros(len(first), np.int64)
        order = np.argsort(-length, kind="stable")
        first, length = first[order], length[order]
        for t in range(int(length[0]) if len(length) else 0):
            live = int(np.searchsorted(-length, -t, "left"))  # documents of more than t words
            at = first[:live] + length[:live] - 1 - t
            c = words[at]
            over = np.flatnonzero(have[:live] == self.cap)
            if over.size and self.cap > 1:
                start, end = self._parents(self.cap - 1)
                lo[over], hi[over] = start[lo[over]], end[lo[over]]
                have[over] = self.cap - 1
            elif over.size:
                lo[over], hi[over], have[over] = 0, self.size, 0
            todo = np.arange(live)
            while todo.size:
                s = c[todo]
                known = s >= 0
                s = np.maximum(s, 0)
                a = self.starts[s] + self.matrix.rank(s, lo[todo])
                b = self.starts[s] + self.matrix.rank(s, hi[todo])
                good = known & (a < b)
                hit = todo[good]
                lo[hit], hi[hit] = a[good], b[good]
                have[hit] += 1
                rest = todo[~good]
                stop = rest[(have[rest] == 0) | (c[rest] < 0)]
                lo[stop], hi[stop], have[stop] = 0, self.size, 0
                todo = rest[(have[rest] > 0) & (c[rest] >= 0)]
                for d in np.unique(have[todo]):
                    some = todo[have[todo] == d]
                    if d == 1:
                        lo[some], hi[some] = 0, self.size
                    else:
                        start, end = self._parents(int(d) - 1)
                        lo[some], hi[some] = start[lo[some]], end[lo[some]]
                    have[some] = d - 1
            size[at], low[at], high[at] = have[:live], lo[:live], hi[:live]
        return size, low, high
