"""FM-index over a sequence of integer symbols: count and locate many patterns at once."""

from __future__ import annotations

import numpy as np


class WaveletRanks:
    """Rank queries on a sequence by a wavelet tree stored level by level."""

    def __init__(self, sequence: np.ndarray, size: int):
        self.bits = max(1, int(size - 1).bit_length())
        self.zeros, self.ones = [], []
        for level in range(self.bits - 1, -1, -1):
            bit = (sequence >> level) & 1
            sums = np.zeros(len(sequence) + 1, np.int32)
            np.cumsum(bit, out=sums[1:])
            self.ones.append(sums)
            self.zeros.append(len(sequence) - int(sums[-1]))
            sequence = np.concatenate((sequence[bit == 0], sequence[bit == 1]))  # stable split

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        low = np.zeros(len(at), np.int64)
        for depth in range(self.bits):
            ones, zeros = self.ones[depth], self.zeros[depth]
            bit = (symbol >> (self.bits - 1 - depth)) & 1
            at = np.where(bit == 1, zeros + ones[at], at - ones[at])
            low = np.where(bit == 1, zeros + ones[low], low - ones[low])
        return at - low

    def symbols(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position and its rank there."""
        symbol = np.zeros(len(at), np.int64)
        low = np.zeros(len(at), np.int64)
        for depth in range(self.bits):
            ones, zeros = self.ones[depth], self.zeros[depth]
            bit = ones[at + 1] - ones[at]
            symbol = symbol * 2 + bit
            at = np.where(bit == 1, zeros + ones[at], at - ones[at])
            low = np.where(bit == 1, zeros + ones[low], low - ones[low])
        return symbol, at - low


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Start of each suffix in lexical order, by doubling the compared length.

    Only suffixes that still tie are sorted again, so long repeats in a few places do not
    make every round cost as much as the first.
    """
    n = len(text)
    order = np.argsort(text, kind="stable")
    ordered = text[order]
    head = np.ones(n, bool)
    head[1:] = ordered[1:] != ordered[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    width = 1
    while True:
        last = np.ones(n, bool)
        last[:-1] = head[1:]
        open_ = np.flatnonzero(~(head & last))  # places in groups of several
        if not len(open_):
            return order
        who = order[open_]
        nxt = who + width
        second = np.where(nxt < n, rank[np.minimum(nxt, n - 1)], -1)
        group = rank[who]
        again = np.lexsort((second, group))
        who, second, group = who[again], second[again], group[again]
        order[open_] = who
        fresh = np.ones(len(who), bool)
        fresh[1:] = (group[1:] != group[:-1]) | (second[1:] != second[:-1])
        head[open_] = fresh
        rank[who] = open_[np.maximum.accumulate(np.where(fresh, np.arange(len(who)), 0))]
        width *= 2


class FMIndex:
    """Index of runs of symbols 1..size-1, each run ended by a 0.

    Suffix positions are sampled at the start of each run and every ``step`` symbols after
    it, so locating walks back less than ``step`` symbols and never out of its run.
    """

    def __init__(self, runs: np.ndarray, size: int, step: int = 8):
        ends = np.flatnonzero(runs == 0)
        # Each end sorts on its own, before all symbols: no comparison goes past it.
        keys = runs.astype(np.int64) + len(ends)
        keys[ends] = np.arange(len(ends))
        order = suffix_order(keys)
        before = runs[order - 1]
        self.n = len(runs)
        self.before = np.bincount(runs, minlength=size + 1).cumsum()
        self.starts = np.concatenate(([0], self.before))[: size + 1]
        self.ranks = WaveletRanks(before.astype(np.int64), size)
        run_start = np.concatenate(([0], ends + 1))[np.searchsorted(ends, np.arange(self.n))]
        sampled = (np.arange(self.n) - run_start) % step == 0
        marked = sampled[order]
        self.mark = np.zeros(self.n + 1, np.int64)
        np.cumsum(marked, out=self.mark[1:])
        self.samples = order[marked]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of suffixes that begin with each pattern (rows, padded at the end)."""
        low = np.zeros(len(lengths), np.int64)
        high = np.full(len(lengths), self.n, np.int64)
        for back in range(int(lengths.max(initial=0))):
            live = np.flatnonzero((back < lengths) & (low < high))
            if not len(live):
                break
            symbol = patterns[live, lengths[live] - 1 - back]
            low[live] = self.starts[symbol] + self.ranks.rank(symbol, low[live])
            high[live] = self.starts[symbol] + self.ranks.rank(symbol, high[live])
        return low, np.maximum(high, low)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Position in the text of each suffix row."""
        where = np.full(len(rows), -1, np.int64)
        steps = np.zeros(len(rows), np.int64)
        rows, live = rows.copy(), np.arange(len(rows))
        while len(live):
            at = rows[live]
            known = self.mark[at + 1] > self.mark[at]
            where[live[known]] = self.samples[self.mark[at[known]]] + steps[live[known]]
            live = live[~known]
            if len(live):
                symbol, rank = self.ranks.symbols(rows[live])
                rows[live] = self.starts[symbol] + rank
                steps[live] += 1
        return where
