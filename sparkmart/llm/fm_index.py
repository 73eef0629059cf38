"""FM-index over a sequence of symbols: backward search by wavelet ranks, locating by sampled positions.

The sequence is made of runs of symbols 1..sigma-1, each run ended by the
separator 0.  Separators count as different from each other in the suffix
order, so the sort needs rounds in the logarithm of the longest run only, and
no pattern (which has no separator) can span two runs.
"""

from __future__ import annotations

import numpy as np

#: A suffix position is stored for the run's first symbol and every so many after it.
SAMPLE = 8


class FMIndex:
    def __init__(self, sequence: np.ndarray, offset_in_run: np.ndarray, sigma: int):
        """``offset_in_run``: distance of every symbol from its run's start."""
        n = len(sequence)
        self.n, self.levels = n, max(1, int(sigma - 1).bit_length())
        order = _suffix_order(sequence)
        last = sequence[order - 1]  # the symbol before the first one is the last separator
        self.before = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=1 << self.levels))]).astype(np.int64)
        self.last = last
        sampled = (offset_in_run[order] % SAMPLE == 0) & (sequence[order] != 0)
        self.sampled = sampled
        self.place = np.cumsum(sampled) - 1
        self.samples = order[sampled]
        # Wavelet matrix: per level the running number of ones and the number of zeros.
        self.ones, self.zeros = [], []
        row = last.astype(np.int64)
        for level in range(self.levels - 1, -1, -1):
            bit = (row >> level) & 1
            ones = np.zeros(n + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(n - int(ones[-1]))
            row = np.concatenate([row[bit == 0], row[bit == 1]])

    def _ranks(self, symbol: np.ndarray, *ends: np.ndarray) -> list[np.ndarray]:
        """Occurrences of each symbol in the last column before each end."""
        start = np.zeros(len(symbol), np.int64)
        ends = [e.astype(np.int64) for e in ends]
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            ones, zeros = self.ones[k], self.zeros[k]
            up = ((symbol >> level) & 1).astype(np.bool_)
            for i, e in enumerate([start, *ends]):
                o = ones[e]
                moved = np.where(up, zeros + o, e - o)
                if i:
                    ends[i - 1] = moved
                else:
                    start = moved
        return [e - start for e in ends]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pattern, low, high): suffix ranges of the patterns that occur; rows of ``patterns`` are right-aligned."""
        which = np.arange(len(patterns))
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        width = patterns.shape[1]
        for step in range(1, width + 1):
            go = lengths[which] >= step
            symbol = patterns[which[go], width - step]
            a, b = self._ranks(symbol, low[go], high[go])
            low[go], high[go] = self.before[symbol] + a, self.before[symbol] + b
            some = high > low
            which, low, high = which[some], low[some], high[some]
            if not len(which):
                break
        return which, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Position in the sequence of the suffix of each row, by steps back to a sampled one."""
        out = np.empty(len(rows), np.int64)
        todo, at, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(todo):
            found = self.sampled[at]
            out[todo[found]] = self.samples[self.place[at[found]]] + steps
            todo, at = todo[~found], at[~found]
            if len(todo):
                symbol = self.last[at]
                at = self.before[symbol] + self._ranks(symbol, at)[0]
                steps += 1
        return out


def _suffix_order(sequence: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling; separators (0) differ by position."""
    n = len(sequence)
    sep = sequence == 0
    rank = sequence.astype(np.int64) + int(sep.sum())
    rank[sep] = np.arange(int(sep.sum()))
    step = 1
    order = np.argsort(rank, kind="stable")
    rank = _dense(rank, order)
    while rank[order[-1]] + 1 < n:
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        rank = _dense(key, order)
        step *= 2
    return order


def _dense(key: np.ndarray, order: np.ndarray) -> np.ndarray:
    rank = np.empty(len(key), np.int64)
    s = key[order]
    rank[order] = np.concatenate([[0], np.cumsum(s[1:] != s[:-1])])
    return rank
