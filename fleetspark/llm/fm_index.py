"""Run-length FM-index over integer symbols: backward search on a wavelet matrix, for many texts in step (numpy).

The Burrows-Wheeler transform of texts that hold the same passages falls into
long runs of one symbol. Only the first symbol of each run goes into the
wavelet matrix; run starts and running run lengths by symbol give the ranks of
the whole transform. In place of a suffix array, each group of rows that share
``threshold`` symbols keeps one value, the smallest of its texts.
"""

from __future__ import annotations

import numpy as np

from .common import runs
from .suffixes import neighbour_lcp, suffix_array

_FULL = np.uint64(63)


class BitRank:
    """A bit vector in 64-bit words with a running count before each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words), np.int32)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each position."""
        word = at >> 6
        mask = (np.uint64(1) << (at.astype(np.uint64) & _FULL)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def bit(self, at: np.ndarray) -> np.ndarray:
        """The bit at each position (0 at the end)."""
        return (self.words[at >> 6] >> (at.astype(np.uint64) & _FULL)) & np.uint64(1)


class WaveletMatrix:
    """Rank of any symbol before any position, in one bit-vector rank for each bit of a symbol."""

    def __init__(self, text: np.ndarray, kinds: int):
        self.bits = max(1, int(kinds - 1).bit_length())
        self.levels: list[tuple[BitRank, int]] = []
        for level in range(self.bits - 1, -1, -1):
            bit = ((text >> level) & 1).astype(bool)
            self.levels.append((BitRank(bit), int(len(text) - bit.sum())))
            text = np.concatenate((text[~bit], text[bit]))

    def descend(self, symbol: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position in the last level, and if the symbol stands at the position that the descent started from.

        The difference to the last-level position of 0 is the symbol's rank.
        """
        here = np.ones(len(at), bool)
        for level, (bits, zeros) in enumerate(self.levels):
            ones = bits.ones(at)
            one = (symbol >> (self.bits - 1 - level)) & 1
            here &= bits.bit(at) == one.astype(np.uint64)
            at = np.where(one, zeros + ones, at - ones)
        return at, here


class RunLengthTransform:
    """Steps of the backward search over a transform that is kept as runs of equal symbols."""

    def __init__(self, transform: np.ndarray, kinds: int):
        self.start = runs(transform)[:-1].astype(np.int32)
        symbol = transform[self.start]
        length = np.diff(np.append(self.start, len(transform)))
        self.wavelet = WaveletMatrix(symbol, kinds)
        before = np.zeros(kinds, np.int64)  # runs of smaller symbols
        np.cumsum(np.bincount(symbol, minlength=kinds)[:-1], out=before[1:])
        self.shift = (before - self.wavelet.descend(np.arange(kinds), np.zeros(kinds, np.int64))[0]).astype(np.int32)
        self.total = np.zeros(len(symbol) + 1, np.int32)  # symbols in the runs before, runs in order of their symbol
        np.cumsum(length[np.argsort(symbol, kind="stable")], out=self.total[1:])

    def step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Symbols smaller than ``symbol`` in the whole transform, and equal ones before ``row``."""
        run = np.searchsorted(self.start, row, "right") - 1
        last, inside = self.wavelet.descend(symbol, run)
        return self.total[last + self.shift[symbol]] + np.where(inside, row - self.start[run], 0)


class FMIndex:
    """Index of several texts for matches of ``threshold`` symbols.

    symbols: dense symbols from 0, one text after the other; start: first
    symbol of each text; values: a number for each text. Every text is closed
    by a symbol of its own, so no match crosses texts. Suffixes are sorted to
    the threshold's depth only. ``least`` holds, for each group of rows that
    share ``threshold`` symbols, the smallest value of its texts.
    """

    def __init__(self, symbols: np.ndarray, start: np.ndarray, kinds: int, threshold: int, values: np.ndarray):
        n, m = len(symbols), len(start)
        self.threshold = threshold
        text_of = np.searchsorted(start, np.arange(n), "right") - 1
        closed = np.empty(n + m, np.int64)
        closed[np.arange(n) + text_of] = symbols
        closed[np.append(start[1:], n) + np.arange(m)] = kinds + np.arange(m)
        owner = np.empty(n + m, np.int32)
        owner[np.arange(n) + text_of] = text_of
        owner[np.append(start[1:], n) + np.arange(m)] = np.arange(m)
        sa, levels = suffix_array(closed, depth=threshold)
        lcp = neighbour_lcp(sa, levels)
        del levels
        self.rows = len(sa)
        self.same = self._groups(lcp >= threshold)
        self.shorter = self._groups(lcp >= threshold - 1)
        self._enclose(np.minimum(lcp, threshold))
        self.least = np.minimum.reduceat(values[owner[sa]], self.same[:-1])
        # all closing symbols are one for the search
        self.transform = RunLengthTransform(np.minimum(closed[sa - 1], kinds), kinds + 1)

    def _groups(self, joined: np.ndarray) -> np.ndarray:
        """Limits of the groups of rows joined to the row before."""
        return np.concatenate(([0], np.flatnonzero(~joined[1:]) + 1, [self.rows])).astype(np.int32)

    def _enclose(self, lcp: np.ndarray) -> None:
        """For the border before each row, the rows on both sides that agree in as many symbols as those at it.

        The next larger interval of one is that of its deeper border.
        """
        self.depth = np.append(lcp, 0).astype(np.int16)
        self.first = np.zeros(self.rows + 1, np.int32)
        self.after = np.full(self.rows + 1, self.rows, np.int32)
        by_depth = np.argsort(self.depth, kind="stable")
        limits = np.searchsorted(self.depth[by_depth], np.arange(self.threshold + 2))
        for d in range(1, self.threshold + 1):
            border = by_depth[limits[d] : limits[d + 1]]
            if len(border):
                group = self._groups(lcp >= d)
                at = np.searchsorted(group, border, "right")
                self.first[border], self.after[border] = group[at - 1], group[at]

    def windows(self, symbols: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """For each position of the streamed texts symbols[start:end], the group of rows whose first ``threshold``
        symbols are the window that starts there; -1 without a match. Symbols that the index lacks are -1.

        Matching statistics up to the threshold, from the right end of every text: a match is extended to the left by
        backward search; one of full length first gives up its last symbol. Where the search fails, the match gives
        up symbols at its right end until it has more occurrences, by going to the next larger interval, and is tried
        again; so the steps are at most twice the symbols. All texts go on in step.
        """
        found = np.full(len(symbols), -1, np.int64)
        t = self.threshold
        live = np.flatnonzero(end - start >= t)
        low, right = start[live], end[live] - 1  # right: last symbol of the match sought
        at = right.copy()
        sp, ep = np.zeros(len(live), np.int64), np.full(len(live), self.rows, np.int64)
        while len(at):
            full = np.flatnonzero(right - at == t)  # length of the match so far
            if len(full):
                group = np.searchsorted(self.shorter, sp[full], "right") - 1
                sp[full], ep[full] = self.shorter[group], self.shorter[group + 1]
                right[full] -= 1
            c = symbols[at]
            known = c >= 0
            safe = np.where(known, c, 0)
            both = self.transform.step(np.concatenate((safe, safe)), np.concatenate((sp, ep)))
            ok = known & (both[: len(at)] < both[len(at) :])
            hit = np.flatnonzero(ok & (right - at == t - 1))
            found[at[hit]] = np.searchsorted(self.same, both[hit], "right") - 1
            again = ~ok & known & (right > at)
            back = np.flatnonzero(again)
            border = np.where(self.depth[sp[back]] >= self.depth[ep[back]], sp[back], ep[back])
            lost = np.flatnonzero(~ok & ~again)  # no match ends here
            sp, ep = both[: len(at)].copy(), both[len(at) :].copy()
            sp[back], ep[back], right[back] = self.first[border], self.after[border], at[back] + self.depth[border]
            sp[lost], ep[lost], right[lost] = 0, self.rows, at[lost] - 1
            at = at - ~again
            going = (at >= low) & (right - low >= t - 1)
            if not going.all():
                at, right, low, sp, ep = at[going], right[going], low[going], sp[going], ep[going]
        return found
