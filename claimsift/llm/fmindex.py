"""A compressed index of a text of word numbers: Burrows-Wheeler transform in a wavelet matrix, searched backwards.

All operations take arrays, so that many searches advance together.
"""

from __future__ import annotations

import numpy as np

from claimsift.llm.words import U64, flat_ranges

SEPARATOR = 0


def suffix_order(text: np.ndarray, separators: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; separators are told apart by their place, so no match runs across one."""
    rank = text.astype(np.int64) + len(separators)
    rank[separators] = np.arange(len(separators))
    n, step = len(text), 1
    order = np.argsort(rank, kind="stable")
    while True:
        after = np.full(n, -1, np.int64)
        after[:-step or None] = rank[step:] if step < n else after[:0]
        order = np.lexsort((after, rank))
        a, b = rank[order], after[order]
        new = np.concatenate([[0], np.cumsum((a[1:] != a[:-1]) | (b[1:] != b[:-1]))])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1 or step >= n:
            return order
        step *= 2


class Bits:
    """A bit vector with counts of ones before each position: one bit and half a bit of counts per entry."""

    def __init__(self, bits: np.ndarray) -> None:
        words = np.zeros(len(bits) // 64 + 1, U64)
        packed = np.packbits(bits, bitorder="little")
        words.view(np.uint8)[:len(packed)] = packed
        self.words = words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words[:-1]), dtype=np.int64)]).astype(np.uint32)

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones among the first ``at`` bits."""
        block, bit = at >> 6, (at & 63).astype(U64)
        low = self.words[block] & ((U64(1) << bit) - U64(1))
        return self.before[block].astype(np.int64) + np.bitwise_count(low)


class FMIndex:
    """Index of ``text`` (numbers from 1 up, :data:`SEPARATOR` between and after its pieces)."""

    def __init__(self, text: np.ndarray) -> None:
        self.size = len(text)
        self.order = suffix_order(text, np.flatnonzero(text == SEPARATOR))
        last = text[self.order - 1]
        self.levels = max(1, int(text.max()).bit_length())
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=int(text.max()) + 1))])
        self.bits, self.zeros = [], []
        for level in reversed(range(self.levels)):
            bit = (last >> level & 1).astype(bool)
            self.bits.append(Bits(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            last = np.concatenate([last[~bit], last[bit]])

    def count(self, symbol: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each symbol's first entry in the last level, and of the one after its occurrences before ``at``."""
        start = np.zeros_like(at)
        for level, bits, zeros in zip(reversed(range(self.levels)), self.bits, self.zeros):
            one = (symbol >> level & 1).astype(bool)
            a, b = bits.ones(start), bits.ones(at)
            start = np.where(one, zeros + a, start - a)
            at = np.where(one, zeros + b, at - b)
        return start, at

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``symbol`` followed by what rows ``lo`` to ``hi`` start with."""
        start, low = self.count(symbol, lo)
        _, high = self.count(symbol, hi)
        first = self.smaller[symbol]
        return first + low - start, first + high - start

    def runs(self, text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """For each row, the first row and the one after the last that share ``depth`` symbols with it."""
        a, b = self.order[1:], self.order[:-1]
        same = np.ones(len(a), bool)
        for d in range(depth):
            x, y = np.minimum(a + d, self.size - 1), np.minimum(b + d, self.size - 1)
            same &= (text[x] == text[y]) & (text[x] != SEPARATOR)
        edge = np.concatenate([[0], np.flatnonzero(~same) + 1, [self.size]])
        length = np.diff(edge)
        return np.repeat(edge[:-1], length), np.repeat(edge[1:], length)


def matching_windows(index: FMIndex, text: np.ndarray, starts: np.ndarray, lengths: np.ndarray, depth: int
                     ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Streams pieces of words through the index from their ends, all together.

    After each word a search holds the rows that match the longest piece to its right, of ``depth`` words at most: one
    step to the left, then wider to ``depth``. Returns piece, offset and first matching row of every window of
    ``depth`` words, so that equal windows have equal rows.
    """
    low_of, high_of = index.runs(text, depth)
    by_length = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[by_length], lengths[by_length]
    lo, hi = np.zeros(len(starts), np.int64), np.full(len(starts), index.size, np.int64)
    pieces, offsets, rows = [], [], []
    for step in range(int(lengths[0]) if len(lengths) else 0):
        n = int(np.searchsorted(-lengths, -step, "left"))  # those longer than step
        at = lengths[:n] - 1 - step
        lo[:n], hi[:n] = index.extend(text[starts[:n] + at], lo[:n], hi[:n])
        if step >= depth - 1:
            lo[:n], hi[:n] = low_of[lo[:n]], high_of[lo[:n]]
            pieces.append(by_length[:n])
            offsets.append(at)
            rows.append(lo[:n].copy())
    join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return join(pieces), join(offsets), join(rows)


def joined_text(symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The given ranges of symbols, a separator after each, and where each starts."""
    placed = np.cumsum(lengths + 1) - (lengths + 1)
    text = np.full(int((lengths + 1).sum()), SEPARATOR, np.int64)
    text[flat_ranges(placed, lengths)] = symbols[flat_ranges(starts, lengths)]
    return text, placed
