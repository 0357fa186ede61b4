"""Words of many texts at once: positions and 64-bit hashes from the UTF-8 bytes, without Python strings.

A word's hash is a polynomial over per-byte random values, taken from running
sums modulo 2**64, then mixed. It depends on the word's bytes only, so it is
the same in every task. Two different words agree with a chance near 2**-60.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.Generator(np.random.PCG64(20240601)).integers(1, 1 << 63, 256, dtype=np.uint64) | U64(1)
#: Bytes hashed at once; only a longer single word raises it.
BLOCK = 2 << 20
_powers = {"n": 0}

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
ALNUM = np.ones(256, bool)
ALNUM[list(range(0x00, 0x30)) + list(range(0x3A, 0x61)) + list(range(0x7B, 0x80))] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


@dataclass
class Words:
    """Words in page order. ``start``/``end``: byte positions; ``doc``: row; ``hash``: 64 bits; ``offsets``: first word of each row."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    offsets: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i below n, kept for the next call."""
    if _powers["n"] < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            out = np.empty(size, U64)
            out[0], done, step = 1, 1, base
            while done < size:
                more = min(done, size - done)
                out[done : done + more] = out[:more] * U64(step)
                done, step = done + more, step * step % (1 << 64)
            _powers[name] = out
        _powers["n"] = size
    return _powers["up"][:n], _powers["down"][:n]


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for each span; equal value sequences have equal hashes."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(U64))


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts, ends and rows of maximal runs of word bytes; no word crosses a row."""
    inside = is_word[data]
    n = len(data)
    edge = offsets[(offsets > 0) & (offsets < n)]
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before[edge] = False
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[edge - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def byte_span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of byte spans in rising order, worked through in blocks of bounded size."""
    out = np.empty(len(start), U64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + BLOCK, "right")))
        a, b = int(start[i]), int(end[j - 1])
        out[i:j] = span_hashes(_BYTE[data[a:b]], start[i:j] - a, end[i:j] - a)
        i = j
    return out


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE, lower: bool = False) -> Words:
    """Words of every row: maximal runs of bytes that aren't separators, hashed lower-cased if asked (A-Z)."""
    start, end, doc = word_spans(data, offsets, ~separators)
    hashes = byte_span_hashes(LOWER[data] if lower else data, start, end)
    return Words(start, end, doc, hashes, np.searchsorted(doc, np.arange(len(offsets))))


def gram_hashes(word_hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on (row limits are the caller's)."""
    m = len(word_hashes) - n + 1
    if m <= 0:
        return np.empty(0, U64)
    out = word_hashes[:m].copy()
    for k in range(1, n):
        out = out * U64(0xC2B2AE3D27D4EB4F) + word_hashes[k : k + m]
    return mix(out)


def join_words(data: bytes, start: np.ndarray, end: np.ndarray) -> bytes:
    return b" ".join([data[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)])
