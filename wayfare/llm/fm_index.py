"""FM-index over a text of integer symbols, searched for many patterns at once.

Symbol 0 separates; separators are ordered by position, so every suffix is
unique after the first one.  Ranks come from a wavelet matrix, positions from
sampled suffix positions.  Built and searched with numpy, for one shard of text.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8  # a suffix position is kept where it is a multiple of this


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling; each 0 in the text differs from the others."""
    size = len(text)
    separators = np.flatnonzero(text == 0)
    rank = text.astype(np.int64) + len(separators)
    rank[separators] = np.arange(len(separators))
    order = np.argsort(rank, kind="stable")
    step = 1
    while True:
        following = np.zeros(size, np.int64)
        following[:-step or None] = rank[step:] + 1 if step < size else 0
        key = rank * np.int64(size + len(separators) + int(text.max(initial=0)) + 2) + following
        order = np.argsort(key, kind="stable")
        fresh = np.empty(size, np.int64)
        fresh[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank = fresh
        if not size or rank[order[-1]] == size - 1:
            return order
        step *= 2


class WaveletMatrix:
    """Rank and access on a sequence of integers, one bit plane at a time."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.size = bits, len(symbols)
        self.ones: list[np.ndarray] = []   # ones before each place, by plane
        self.zeros: list[int] = []
        place = np.int32 if self.size < 1 << 31 else np.int64
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level & 1).astype(bool)
            self.ones.append(np.concatenate([np.zeros(1, place), np.cumsum(bit, dtype=place)]))
            self.zeros.append(int(len(bit) - bit.sum()))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        low, high = np.zeros_like(places), places
        for plane, level in enumerate(range(self.bits - 1, -1, -1)):
            one = (symbols >> level & 1).astype(bool)
            ones_low, ones_high = self.ones[plane][low], self.ones[plane][high]
            low = np.where(one, self.zeros[plane] + ones_low, low - ones_low)
            high = np.where(one, self.zeros[plane] + ones_high, high - ones_high)
        return high - low

    def access(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it occurs before."""
        symbols, low, at = np.zeros_like(places), np.zeros_like(places), places
        for plane in range(self.bits):
            ones = self.ones[plane]
            bit = ones[at + 1] > ones[at]
            symbols = symbols * 2 + bit
            low = np.where(bit, self.zeros[plane] + ones[low], low - ones[low])
            at = np.where(bit, self.zeros[plane] + ones[at], at - ones[at])
        return symbols, at - low


class FMIndex:
    """Index of a text (int64 symbols; 0 separates and must end it)."""

    def __init__(self, text: np.ndarray):
        order = suffix_array(text)
        bwt = text[order - 1]
        self.wavelet = WaveletMatrix(bwt, max(1, int(text.max(initial=0)).bit_length()))
        counts = np.bincount(text, minlength=int(text.max(initial=0)) + 2)
        self.below = np.concatenate([[0], np.cumsum(counts)])
        # The start of a run has no symbol to step back to: its position is always kept.
        kept = (order % SAMPLE == 0) | (bwt == 0)
        self.kept_before = np.concatenate([[0], np.cumsum(kept)])
        self.positions = order[kept]

    def ranges(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that begin with each pattern (right-padded rows)."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.wavelet.size, np.int64)
        known = len(self.below) - 2
        for column in range(patterns.shape[1] - 1, -1, -1):
            going = np.flatnonzero((lengths > column) & (low < high))
            symbols = patterns[going, column]
            there = symbols < known
            high[going[~there]] = low[going[~there]]
            going, symbols = going[there], symbols[there]
            base = self.below[symbols]
            low[going] = base + self.wavelet.rank(symbols, low[going])
            high[going] = base + self.wavelet.rank(symbols, high[going])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of the suffix in each row, stepping back to a kept one."""
        rows = rows.copy()
        found, steps = np.full(len(rows), -1, np.int64), 0
        open_ones = np.arange(len(rows))
        while len(open_ones):
            own = rows[open_ones]
            at = self.kept_before[own]
            here = self.kept_before[own + 1] > at
            found[open_ones[here]] = self.positions[at[here]] + steps
            open_ones, own = open_ones[~here], own[~here]
            symbols, before = self.wavelet.access(own)
            rows[open_ones] = self.below[symbols] + before
            steps += 1
        return found
