"""Near-duplicate components among the texts of one packing group (used by op2).

Bins never span packing groups, so only links within a group matter to packing. The group's texts come to one task once; there each distinct shingle set gets
MinHash bands; members of a band are compared with its smallest one, then with each other where they are not in one
component yet. A whole-set odd sketch rejects most pairs, the sets themselves confirm the rest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from . import tokens as tk
from .common import runs, utf8_buffers
from .near_dedup import BANDS, ROWS, SKETCH_BITS, band_keys, set_sketches, shingle_sets, signatures


class Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)

    def roots(self) -> np.ndarray:
        return np.array([self.root(x) for x in range(len(self.up))], np.int64)


def components(texts: pa.Array, shingle: int, percent: int) -> np.ndarray:
    """The component of each text, -1 for texts without words."""
    members, counts = shingle_sets(*utf8_buffers(texts), shingle)
    ends = np.cumsum(counts)
    some = np.flatnonzero(counts)
    out = np.full(len(counts), -1, np.int64)
    if not len(some):
        return out
    prints = np.stack([tk.span_hashes(v, (ends - counts)[some], ends[some]) for v in (members, tk.mix(members + np.uint64(77)))], axis=1)
    _, first, label = np.unique(prints, axis=0, return_index=True, return_inverse=True)
    reps = some[first]
    sets = [members[a:b] for a, b in zip((ends - counts)[reps].tolist(), ends[reps].tolist(), strict=True)]
    n = counts[reps]
    flat = np.concatenate(sets)
    bands = band_keys(signatures(flat, n, BANDS * ROWS))
    sketch = set_sketches(flat, n).view(np.uint64)
    links = Union(len(reps))
    root = np.arange(len(reps))

    def compare(i: np.ndarray, j: np.ndarray) -> bool:
        """Link the pairs that are at the threshold; True if any is new."""
        ok = root[i] != root[j]
        ok &= 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
        i, j = i[ok], j[ok]
        apart = np.bitwise_count(sketch[i] ^ sketch[j]).sum(axis=1, dtype=np.int64) if len(i) else np.empty(0, np.int64)
        maybe = 100 * (n[i] + n[j] - apart) >= percent * (n[i] + n[j] + apart)
        any_new = False
        for x, y in zip(i[maybe].tolist(), j[maybe].tolist(), strict=True):
            if links.root(x) != links.root(y):
                p, q = sets[x], sets[y]
                common = int((p[np.minimum(np.searchsorted(p, q), len(p) - 1)] == q).sum())
                if 100 * common >= percent * (len(p) + len(q) - common):
                    links.join(x, y)
                    any_new = True
        return any_new

    buckets = []
    for band in range(BANDS):
        key = bands[:, band]
        order = np.argsort(key, kind="stable")
        start = runs(key[order])
        size = np.diff(start)
        hub = np.repeat(order[start[:-1]], size)
        rank = np.arange(len(order)) - np.repeat(start[:-1], size)
        if compare(hub[rank > 0], order[rank > 0]):
            root = links.roots()
        buckets.append((order, rank, np.repeat(size, size)))
    for order, rank, size in buckets:
        for step in range(1, int(size.max(initial=0))):
            i = np.flatnonzero((rank > 0) & (rank + step < size))
            if compare(order[i], order[i + step]):
                root = links.roots()
    out[some] = root[label.ravel()]
    return out
