"""Compressed FM-index over integer sequences: wavelet matrix, backward search."""

from __future__ import annotations

import numpy as np


class BitVector:
    """Packed bits with a count per 64-bit word; ``rank(i)`` counts the ones before i."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(np.r_[bits, np.zeros(-len(bits) % 64 + 64, bool)], bitorder="little").view(np.uint64)
        self.words = packed
        self.before = np.r_[0, np.cumsum(np.bitwise_count(packed), dtype=np.int64)[:-1]]
        self.ones = int(bits.sum())

    def rank(self, i: np.ndarray) -> np.ndarray:
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).view(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)


class WaveletMatrix:
    """Wavelet tree of a symbol sequence, one bit vector per bit of the alphabet."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.depth = max(1, int(sigma - 1).bit_length())
        self.levels: list[tuple[BitVector, int]] = []
        s = symbols
        for d in range(self.depth - 1, -1, -1):
            bit = ((s >> d) & 1).astype(bool)
            v = BitVector(bit)
            self.levels.append((v, len(s) - v.ones))
            s = np.concatenate([s[~bit], s[bit]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before position i, relative to its first row in the matrix."""
        for k, (v, zeros) in enumerate(self.levels):
            one = (symbol >> (self.depth - 1 - k)) & 1
            r = v.rank(i)
            i = np.where(one, zeros + r, i - r)
        return i


def suffix_array(text: np.ndarray, length: int) -> np.ndarray:
    """Order of the suffixes by their first ``length`` symbols or more, ties by position.

    Prefix multiplying: as many ranks of following parts as fit 63 bits make one key, 0 standing for the end.
    """
    n = len(text)
    if n < 2 or length < 2:
        return np.argsort(text, kind="stable")
    rank = text.astype(np.int64) + 1
    k = 1
    while k < length:
        bits = max(1, int(rank.max()).bit_length())
        parts = min(max(2, 63 // bits), -(-length // k))
        if bits * parts > 63:
            raise ValueError("too many symbols for an index")
        key = rank.copy()
        for j in range(1, parts):
            key <<= bits
            if j * k < n:
                key[:n - j * k] |= rank[j * k:]
        order = np.argsort(key, kind="stable")
        step = np.r_[0, np.cumsum(np.diff(key[order]) > 0)]
        k *= parts
        if step[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = step + 1
    return order


class FMIndex:
    """Index of a text of symbols 1..sigma-1 (0 separates its parts) for patterns of up to ``length`` symbols."""

    def __init__(self, text: np.ndarray, sigma: int, length: int):
        self.order = suffix_array(text, length)
        bwt = text[self.order - 1]  # the text is a circle: its last symbol precedes the first
        self.first = np.r_[0, np.cumsum(np.bincount(text, minlength=sigma))]
        self.tree = WaveletMatrix(bwt, sigma)
        # where each symbol's rows begin in the matrix, so that a rank is a difference
        self.base = self.tree.rank(np.arange(sigma), np.zeros(sigma, np.int64))

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: intervals of the patterns with ``symbol`` put in front."""
        both = self.tree.rank(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        start = self.first[symbol] - self.base[symbol]
        return start + both[:len(lo)], start + both[len(lo):]

    def matching_windows(self, text: np.ndarray, at: np.ndarray, length: int):
        """Matching statistics of the windows text[i:i+length], cut off at ``length``.

        Returns for each i of ``at`` how many symbols from the window's end
        backwards occur at least twice in the index (its own occurrence is
        one), and the suffix interval of the windows that reach ``length``.
        """
        last = text[at + length - 1]
        lo, hi = self.first[last], self.first[last + 1]
        matched = np.where(hi - lo > 1, 1, 0)
        live = np.flatnonzero(hi - lo > 1)
        lo, hi = lo[live], hi[live]
        for k in range(2, length + 1):
            if not len(live):
                break
            lo, hi = self.extend(text[at[live] + length - k], lo, hi)
            more = hi - lo > 1
            live, lo, hi = live[more], lo[more], hi[more]
            matched[live] = k
        return matched, live, lo, hi

    def first_positions(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Smallest text position in each suffix interval (sparse table of interval minima)."""
        tables = [self.order]
        out = np.empty(len(lo), np.int64)
        level = np.frexp((hi - lo).astype(float))[1] - 1
        for k in np.unique(level):
            m = level == k
            t = self._table(tables, int(k))
            out[m] = np.minimum(t[lo[m]], t[hi[m] - (1 << int(k))])
        return out

    def _table(self, tables: list[np.ndarray], k: int) -> np.ndarray:
        while len(tables) <= k:
            h = 1 << (len(tables) - 1)
            tables.append(np.minimum(tables[-1][:-h], tables[-1][h:]))
        return tables[k]
