"""An FM-index over integer words: suffix order, wavelet-tree ranks, sampled suffix positions."""

from __future__ import annotations

import numpy as np

SAMPLE = 8


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by rank doubling."""
    n = len(symbols)
    if n and 0 <= symbols.min() and symbols.max() < 4 * n:
        rank = (np.cumsum(np.bincount(symbols) > 0) - 1)[symbols]  # counted, which is cheaper than sorted
    else:
        rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    order = None
    width = 1
    while n and rank.max() < n - 1:
        after = np.zeros(n, np.int64)
        after[: n - width] = rank[width:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key)  # equal keys share a rank, so their order is free
        found = key[order]
        rank[order] = np.concatenate(([0], np.cumsum(found[1:] != found[:-1])))
        width *= 2
    return np.argsort(rank) if order is None else order


class FmIndex:
    """``text``: words from 1, in stretches that each end with the separator 0.

    Patterns hold no separator. A position is sampled if it is a multiple of ``SAMPLE`` or
    begins a stretch, so that no way back from a match crosses a separator.
    """

    def __init__(self, text: np.ndarray):
        n = self.size = len(text)
        stops = np.flatnonzero(text == 0)
        unique = text.astype(np.int64) + len(stops)
        unique[stops] = np.arange(len(stops))  # one separator each: suffixes differ at the end of their stretch
        order = suffix_order(unique)
        self.last = text[order - 1].astype(np.int64)  # before each suffix; what precedes position 0 is a separator
        counts = np.bincount(text, minlength=int(text.max(initial=0)) + 2)
        self.first = np.cumsum(counts) - counts
        self.levels = max(1, int(text.max(initial=0)).bit_length())
        self.ones, self.zeros = [], []
        values = self.last
        for level in reversed(range(self.levels)):
            bit = values >> level & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit))))
            self.zeros.append(n - int(self.ones[-1][-1]))
            values = np.concatenate([values[bit == 0], values[bit == 1]])
        starts = np.concatenate(([0], stops[:-1] + 1)) if len(stops) else np.empty(0, np.int64)
        keep = (order % SAMPLE == 0) | np.isin(order, starts)
        self.sampled = keep
        self.sample_rank = np.cumsum(keep) - 1
        self.samples = order[keep]

    def rank(self, word: np.ndarray, position: np.ndarray) -> np.ndarray:
        """How often ``word`` stands in the first ``position`` places of ``last``; both are arrays."""
        low, high = np.zeros_like(position), position
        for level, ones, zeros in zip(reversed(range(self.levels)), self.ones, self.zeros, strict=True):
            bit = word >> level & 1 == 1
            low = np.where(bit, zeros + ones[low], low - ones[low])
            high = np.where(bit, zeros + ones[high], high - ones[high])
        return high - low

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges ``[low, high)`` of patterns ``(n, length)``, from their last word backwards."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size)
        alive = np.arange(len(patterns))
        for column in reversed(range(patterns.shape[1])):
            word = patterns[alive, column].astype(np.int64)
            known = word < len(self.first) - 1
            low[alive[~known]] = high[alive[~known]] = 0
            alive, word = alive[known], word[known]
            low[alive] = self.first[word] + self.rank(word, low[alive])
            high[alive] = self.first[word] + self.rank(word, high[alive])
            alive = alive[low[alive] < high[alive]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, by steps back to a sampled one."""
        rows = rows.copy()
        steps = np.zeros(len(rows), np.int64)
        far = np.flatnonzero(~self.sampled[rows])
        while len(far):
            word = self.last[rows[far]]
            rows[far] = self.first[word] + self.rank(word, rows[far])
            steps[far] += 1
            far = far[~self.sampled[rows[far]]]
        return self.samples[self.sample_rank[rows]] + steps
