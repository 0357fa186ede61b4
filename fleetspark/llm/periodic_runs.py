"""Periodic runs of words by dyadic square catching (op12).

A square is a word sequence twice in a row; overlapping squares of one period merge into a run, a maximal stretch whose
words are equal ``period`` words apart. Every completed block of 2**k words sets a catcher that lives for the next
2**(k+1) words. With each word appended, every live catcher advances one suffix comparison: does the text now end in a copy
of its block? The copy lies p words behind the block, so a square of period p may have been completed, with 2**k <= p <
2**(k+1) (the smallest blocks take all shorter periods). A catch is extended to both sides as far as the words agree; if
the stretch is long enough it is a run, and catches of one stretch merge into the one of the smallest period.

All catchers of one level, of all documents of a slice, advance together: the step for the p-th word after the block is one vector
comparison of block hashes, n comparisons a level or n log n for a text of n words. Every run of at least ``min_length``
words and three periods holds a whole block before its last period, so none is missed.

Every row is judged alone: no shuffle, memory bounded by a slice of the batch (or one longer text). Defined cases: a NULL or empty text has no run and
collapses to the empty text; with ``planted`` a row without an id stays as it is; repeated rows give repeated
results; ties for the greatest exponent go to the smaller start, then the smaller period; an empty table gives an empty result; only the id and the text are read.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType

from . import tokens as tk
from .common import clean_columns, list_column, map_slices, utf8_buffers

MIN_LENGTH = 24
#: Blocks of the lowest level: a run of 24 words and three periods holds one of 2**3 words at any alignment.
LOWEST = 3


class Hashes:
    """Hashes of word spans from running sums, and how far two places agree."""

    def __init__(self, values: np.ndarray):
        self.up, self.down = tk.powers(len(values) + 1)
        self.values = values
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(tk.mix(values) * self.up[: len(values)], out=self.sums[1:])

    def spans(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.down[start]

    def agree(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """Number of equal words, at most ``most``, from a and b on or, backwards, before them."""
        done = np.zeros(len(a), np.int64)
        step = 1 << max(0, int(most.max(initial=0)).bit_length() - 1)
        while step:
            fits = np.flatnonzero(done + step <= most)
            x, y = a[fits], b[fits]
            x, y = (x - done[fits] - step, y - done[fits] - step) if back else (x + done[fits], y + done[fits])
            done[fits[self.spans(x, step) == self.spans(y, step)]] += step
            step >>= 1
        return done


def catches(h: Hashes, first: np.ndarray, end: np.ndarray, level: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, block start, period) of all catches of one level; ``first``/``end``: word limits of each document."""
    size = 1 << level
    low, high = (1 if level == LOWEST else size), 2 * size
    long_enough = np.flatnonzero(end - first >= np.maximum(least, 3 * low))
    blocks = (end[long_enough] - first[long_enough]) // size
    doc = np.repeat(long_enough, blocks)
    at = first[doc] + size * (np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks))
    if not len(at):
        return doc, at, at
    limit = end[doc]
    begin, stop = int(first[long_enough[0]]), int(end[long_enough[-1]])
    places = np.arange(begin, stop - size + 1)
    names = h.spans(places, size)
    own = names[at - begin]
    found = []
    if high - low <= len(at):
        for p in range(low, high):  # the word p places after the block's last one is appended
            where = np.flatnonzero(at + p + size <= limit)
            hit = where[own[where] == names[at[where] + p - begin]]
            if len(hit):
                found.append((doc[hit], at[hit], np.full(len(hit), p)))
    else:
        for i in range(len(at)):
            a, b = at[i] + low - begin, min(at[i] + high, limit[i] - size + 1) - begin
            hit = np.flatnonzero(names[a:b] == own[i])
            if len(hit):
                found.append((np.full(len(hit), doc[i]), np.full(len(hit), at[i]), hit + low))
    if not found:
        none = np.empty(0, np.int64)
        return none, none, none
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def exact(values: np.ndarray, first: np.ndarray, end: np.ndarray, rows: np.ndarray, least: int) -> np.ndarray:
    """The rows whose words are equal a period apart; where the sums of two different spans agreed, all runs of that period
    of the document instead."""
    good = []
    for doc, start, length, p in rows.tolist():
        a = int(first[doc]) + start
        if np.array_equal(values[a : a + length - p], values[a + p : a + length]):
            good.append((doc, start, length, p))
            continue
        own = values[first[doc] : end[doc]]
        edges = np.flatnonzero(np.diff(np.concatenate(([False], own[:-p] == own[p:], [False])).astype(np.int8)))
        good += [(doc, s, e - s + p, p) for s, e in edges.reshape(-1, 2).tolist() if e - s + p >= max(least, 3 * p)]
    return np.array(good, np.int64).reshape(-1, 4)


def find_runs(values: np.ndarray, offsets: np.ndarray, least: int = MIN_LENGTH) -> np.ndarray:
    """Rows (document, start, length, period), sorted, of all runs of at least ``least`` words and three periods; ``values``: word hashes, ``offsets``:
    first word of each document and the end; starts count from the document's first word."""
    h = Hashes(values)
    first, end = offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64)
    longest = int((end - first).max(initial=0))
    runs = np.empty((0, 4), np.int64)
    level = LOWEST
    while longest >= max(least, 3 << level if level > LOWEST else 0):
        doc, at, p = catches(h, first, end, level, least)
        if len(runs) and len(doc):
            # A catch within a known run whose period divides its own adds nothing.
            key = runs[:, 0] * (len(values) + 1) + runs[:, 1]
            near = np.searchsorted(key, doc * (len(values) + 1) + at - first[doc], "right") - 1
            r = runs[near]
            known = (near >= 0) & (r[:, 0] == doc) & (at - first[doc] + p + (1 << level) <= r[:, 1] + r[:, 2]) & (p % r[:, 3] == 0)
            doc, at, p = doc[~known], at[~known], p[~known]
        if len(doc):
            left = h.agree(at, at + p, at - first[doc], back=True)
            right = h.agree(at, at + p, end[doc] - at - p, back=False)
            rows = np.column_stack([doc, at - left - first[doc], left + right + p, p])
            rows = rows[rows[:, 2] >= np.maximum(least, 3 * rows[:, 3])]
            runs = np.concatenate([runs, exact(values, first, end, np.unique(rows, axis=0), least)])
            runs = runs[np.lexsort((runs[:, 3], runs[:, 2], runs[:, 1], runs[:, 0]))]
            same = np.zeros(len(runs), bool)  # the smallest period of a stretch comes first
            same[1:] = (runs[1:, :3] == runs[:-1, :3]).all(1)
            runs = runs[~same]
        level += 1
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def _greater(a: list[int], b: list[int]) -> int:
    """Order of (start, length, period) by exact exponent, then start, then period."""
    return b[1] * a[2] - a[1] * b[2] or a[0] - b[0] or a[2] - b[2]


def planted_words(n: int, ident: int | None) -> np.ndarray | None:
    """Which word stands in each place of a text of n words after the planting; None: no change."""
    if ident is None or not n:
        return None
    h = zlib.crc32(str(ident).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % period)


def collapsed(data: np.ndarray, start: np.ndarray, end: np.ndarray, lo: int, hi: int, plain: bool) -> bytes:
    """The words, joined by one space; plain: those of data[lo:hi], in order and whole."""
    if not plain:
        raw = data[lo:hi].tobytes()
        return b" ".join([raw[a - lo : b - lo] for a, b in zip(start.tolist(), end.tolist(), strict=True)])
    if not len(start):
        return b""
    part = data[start[0] : end[-1]]
    blank = tk.SPACE[part]
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1]
    return np.where(blank, 0x20, part)[keep].astype(np.uint8).tobytes()


def judge(batch: pa.RecordBatch, planted: bool, least: int) -> dict[str, pa.Array]:
    data, offsets = utf8_buffers(batch.column(1))
    idents = batch.column(0).to_pylist()
    w = tk.words(data, offsets)
    place = np.arange(len(w.hash))
    changed = np.zeros(len(idents), bool)
    if planted:
        for d, ident in enumerate(idents):
            a, b = int(w.offsets[d]), int(w.offsets[d + 1])
            own = planted_words(b - a, ident)
            if own is not None:
                place[a:b] = a + own
                changed[d] = True
    runs = find_runs(w.hash[place], w.offsets, least)
    limits = np.searchsorted(runs[:, 0], np.arange(len(idents) + 1))
    out = {name: [] for name in ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")}
    spans = []
    for d in range(len(idents)):
        own = runs[limits[d] : limits[d + 1], 1:].tolist()
        a, b = int(w.offsets[d]), int(w.offsets[d + 1])
        words = place[a:b]
        if own:
            gone = np.zeros(b - a + 1, np.int64)
            for s, length, p in own:
                gone[s + p] += 1
                gone[s + length] -= 1
            words = words[np.cumsum(gone[:-1]) == 0]
            best = min(own, key=cmp_to_key(_greater))
            figures = (*best, 1000 * best[1] // best[2])
        else:
            figures = (None,) * 4
        text = collapsed(data, w.start[words], w.end[words], int(offsets[d]), int(offsets[d + 1]), not own and not changed[d])
        listed = "".join(f"{s},{length},{p}\n" for s, length, p in own)
        out["n_runs"].append(len(own))
        for name, x in zip(("start", "length", "period", "exponent_milli"), figures, strict=True):
            out[name].append(x)
        out["runs_sha256"].append(hashlib.sha256(listed.encode()).hexdigest())
        out["collapsed_sha256"].append(hashlib.sha256(text).hexdigest())
        spans.append(text)
    kinds = {name: pa.string() if name.endswith("sha256") else pa.int64() for name in out}
    found = {name: pa.array(x, kinds[name]) for name, x in out.items()}
    found["runs"] = list_column(runs[:, 1:].ravel(), 3 * np.diff(limits), pa.int64())
    found["collapsed"] = pa.array(spans, pa.binary()).cast(pa.string())
    return found


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, planted: bool = False) -> DataFrame:
    """(id, n_runs, start, length, period, exponent_milli of the run with the greatest exponent, runs_sha256,
    collapsed_sha256, runs, collapsed) for every row. ``runs`` lists start, length and period of each run, one after the
    other; ``collapsed`` is the text without the words that a run repeats after its first period. ``min_length`` is at
    least 24. ``planted`` first makes the texts of a tenth of the ids periodic from some word on."""
    if min_length < MIN_LENGTH:
        raise ValueError("min_length: at least 24")
    rows = clean_columns(docs, id_col, text_col)
    schema = rows.select(id_col).schema
    for name in ("n_runs", "start", "length", "period", "exponent_milli"):
        schema = schema.add(name, "long")
    schema = schema.add("runs_sha256", "string").add("collapsed_sha256", "string").add("runs", ArrayType(LongType())).add("collapsed", "string")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = judge(batch, planted, min_length)
        return pa.RecordBatch.from_arrays([batch.column(0), *found.values()], [id_col, *found])

    return map_slices(rows, run, schema, text_col)
