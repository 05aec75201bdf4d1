"""An FM-index over runs of whole numbers: backward search and locate, in numpy."""

import numpy as np


class WaveletRanks:
    """Ranks of symbols in a sequence, one bit level at a time, high bit first."""

    def __init__(self, symbols, n_symbols):
        self.bits = max(1, int(n_symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        level = symbols
        for shift in range(self.bits - 1, -1, -1):
            bit = (level >> shift) & 1
            ones = np.zeros(len(level) + 1, dtype=np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(level) - int(ones[-1]))
            level = np.concatenate([level[bit == 0], level[bit == 1]])

    def rank(self, symbol, end):
        """How often ``symbol`` stands before place ``end``, for arrays of both."""
        low, high = np.zeros_like(end), end
        for k in range(self.bits):
            ones, bit = self.ones[k], (symbol >> (self.bits - 1 - k)) & 1
            below_low, below_high = ones[low], ones[high]
            low = np.where(bit == 1, self.zeros[k] + below_low, low - below_low)
            high = np.where(bit == 1, self.zeros[k] + below_high, high - below_high)
        return high - low


def suffix_order(runs):
    """Suffixes of the sequence in order; each 0 ends a run and differs from every other 0.

    Prefix doubling; because runs end in distinct marks, the longest run bounds the rounds.
    """
    n = len(runs)
    ends = runs == 0
    rank = np.where(ends, np.cumsum(ends) - 1, runs.astype(np.int64) + int(ends.sum()))
    step = 1
    while True:
        following = np.full(n, -1, dtype=np.int64)
        following[:-step] = rank[step:]
        # Past the end of its run a suffix is already told apart by the mark.
        key = rank * (int(rank.max()) + 2) + following + 1
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if int(rank[order[-1]]) == n - 1 or step >= n:
            return order
        step *= 2


class FMIndex:
    """Index of ``runs``, an array of symbols from 1 in which 0 ends each run."""

    def __init__(self, runs, n_symbols, sample_every=8):
        self.n = len(runs)
        order = suffix_order(runs)
        self.bwt = runs[order - 1]  # before the first suffix stands the last mark
        self.ranks = WaveletRanks(self.bwt, n_symbols)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(runs, minlength=n_symbols))])
        # Kept: every n-th place, and places after a mark, from which one cannot step back.
        kept = (order % sample_every == 0) | (self.bwt == 0)
        self.kept_before = np.concatenate([[0], np.cumsum(kept)])
        self.kept_places = order[kept]

    def search(self, patterns):
        """Suffix ranges [low, high) of equally long patterns, one a row of the matrix."""
        low = np.zeros(len(patterns), dtype=np.int64)
        high = np.full(len(patterns), self.n, dtype=np.int64)
        live = np.arange(len(patterns))
        for k in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[live, k]
            low[live] = self.first[symbol] + self.ranks.rank(symbol, low[live])
            high[live] = self.first[symbol] + self.ranks.rank(symbol, high[live])
            live = live[low[live] < high[live]]
            if not len(live):
                break
        return low, np.maximum(low, high)

    def locate(self, rows):
        """Places of the suffixes at ``rows``: step back until a kept place is met."""
        rows, steps = rows.copy(), np.zeros(len(rows), dtype=np.int64)
        todo = np.arange(len(rows))
        while True:
            at = rows[todo]
            todo = todo[self.kept_before[at + 1] == self.kept_before[at]]
            if not len(todo):
                return self.kept_places[self.kept_before[rows]] + steps
            at = rows[todo]
            symbol = self.bwt[at]
            rows[todo] = self.first[symbol] + self.ranks.rank(symbol, at)
            steps[todo] += 1
