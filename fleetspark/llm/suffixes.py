"""Suffix arrays and longest common prefixes over integer symbols, in numpy.

Prefix doubling: suffixes are sorted by 1, 2, 4, ... symbols. A rank is the
first row of the bucket of suffixes that still agree, so suffixes that stand
alone keep their rank and only the others are sorted again.
"""

from __future__ import annotations

import numpy as np


def dense_ranks(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Rank of each key from 0, and the number of different keys."""
    if not len(keys):
        return np.empty(0, np.int64), 0
    order = np.argsort(keys, kind="stable")
    new = np.empty(len(keys), bool)
    new[0] = False
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(new)
    return rank, int(new.sum()) + 1


def _buckets(sorted_keys: np.ndarray, base: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """First row of each row's bucket in sorted order (plus base), and if it is alone in it."""
    m = len(sorted_keys)
    new = np.empty(m, bool)
    new[0] = True
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(m), 0))
    alone = new.copy()
    alone[:-1] &= new[1:]
    return first + base, alone


def suffix_array(symbols: np.ndarray, depth: int | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
    """(suffix array, ranks by the first 1, 2, 4, ... symbols).

    With ``depth`` the order is right for that many symbols at least, and ties
    beyond are left open. The last symbol should occur once.
    """
    n = len(symbols)
    if not n:
        return np.empty(0, np.int64), []
    sa = np.argsort(symbols, kind="stable")
    first, alone = _buckets(symbols[sa], 0)
    rank = np.empty(n, np.int64)
    rank[sa] = first
    levels, k = [rank], 1
    rows = np.flatnonzero(~alone)  # rows of sa whose suffix isn't settled
    while len(rows) and (depth is None or k < depth):
        live = sa[rows]
        follow = live + k
        second = np.where(follow < n, rank[np.minimum(follow, n - 1)] + 1, 0)
        key = rank[live] * (n + 2) + second
        order = np.argsort(key, kind="stable")
        live, key = live[order], key[order]
        sa[rows] = live
        within, alone = _buckets(key, 0)
        bucket = rank[live]
        start = np.maximum.accumulate(np.where(np.concatenate(([True], bucket[1:] != bucket[:-1])), np.arange(len(rows)), 0))
        rank = rank.copy()
        rank[live] = bucket + within - start
        levels.append(rank)
        rows = rows[~alone]
        k *= 2
    return sa, levels


def neighbour_lcp(sa: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Symbols that each suffix shares with the row before (0 for the first), by binary descent over the levels.

    Where the array was sorted to a depth, the value is right up to it.
    """
    n = len(sa)
    lcp = np.zeros(n, np.int64)
    if n < 2:
        return lcp
    a, b, row = sa[:-1].copy(), sa[1:].copy(), np.arange(1, n)
    keep = levels[0][a] == levels[0][b]
    a, b, row = a[keep], b[keep], row[keep]
    for j in range(len(levels) - 1, -1, -1):
        hit = (a < n) & (b < n)
        hit[hit] = levels[j][a[hit]] == levels[j][b[hit]]
        a[hit] += 1 << j
        b[hit] += 1 << j
        lcp[row[hit]] += 1 << j
    return lcp


def longest_repeats(words: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each word, the length of the longest word sequence from it on that occurs again in its document.

    words: hashes, doc: rising row numbers. Words of different documents count
    as different symbols and a unique symbol ends each document, so all
    documents of a slice are worked through in one suffix array.
    """
    n = len(words)
    if not n:
        return np.empty(0, np.int64)
    ends = np.flatnonzero(np.concatenate((doc[1:] != doc[:-1], [True])))
    place = np.arange(n) + np.searchsorted(ends, np.arange(n), "left")
    rank, kinds = dense_ranks(words ^ (doc.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    symbols = np.empty(n + len(ends), np.int64)
    symbols[place] = rank
    symbols[place[ends] + 1] = kinds + np.arange(len(ends))
    sa, levels = suffix_array(symbols)
    lcp = neighbour_lcp(sa, levels)
    longest = np.empty(len(sa), np.int64)
    longest[sa] = np.maximum(lcp, np.concatenate((lcp[1:], [0])))
    return longest[place]


def covered(longest: np.ndarray, least: int) -> np.ndarray:
    """Which words lie in the union of the repeated spans of at least ``least`` words."""
    at = np.flatnonzero(longest >= least)
    steps = np.zeros(len(longest) + 1, np.int64)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + longest[at], -1)
    return np.cumsum(steps[:-1]) > 0
