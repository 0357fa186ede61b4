"""Benchmark decontamination with an Aho-Corasick automaton over normalised items (op4).

Items (questions and answers) are normalised as the documents are: A-Z lower
case, words are runs of ASCII letters, digits and non-ASCII characters. Each
window of ``WINDOW`` item words (a shorter item whole) is one pattern; the
automaton scans each normalised document once, and the end of every match is
mapped back to words and to characters of the original text.

The windows are made and counted by Spark and dealt, by a hash of window and
item, to blocks of about ``BLOCK_WINDOWS``; so no item and no window that many
items share makes a block larger. The driver holds one block at a time, and a
task one automaton. A usual benchmark is one block: documents are scanned in
one pass and never shuffled. Each block of a larger one is a pass of its own
whose hits are stored, by text (a row for each text that is hit); in the end they are
united and joined to the documents.

Defined cases: NULL and empty texts have no words, no hits and aren't
contaminated; an item without words has no windows; equal windows of several
items count for each of them; repeated items with one id count once; NULL item
ids are left out of the item list and of n_items, though their windows mark
words; repeated documents give repeated results; empty tables give an empty
result, and an empty benchmark no hits. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from . import tokens as tk
from .common import in_arrow, map_slices, stored

WINDOW = 13
#: Windows of a block, about 6 KB of automaton each.
BLOCK_WINDOWS = 10_000

_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if tk.ALNUM[b] else 32 for b in range(256))


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def patterns(items: list[tuple[int | None, str | None]], window: int) -> dict[bytes, set]:
    """Normalised window -> ids of the items that have it."""
    out: dict[bytes, set] = defaultdict(set)
    for item, text in items:
        for pattern in windows(text, window):
            out[pattern].add(item)
    return out


def windows(text: str | None, window: int) -> Iterator[bytes]:
    words = normal_words((text or "").encode())
    for k in range(max(1, len(words) - window + 1) if words else 0):
        yield b" ".join(words[k : k + window])


def automaton(found: dict[bytes, set]) -> ahocorasick.Automaton:
    """Patterns carry a space at both ends, so that they match whole words only; Latin-1 keeps one character a byte."""
    machine = ahocorasick.Automaton()
    for pattern, items in found.items():
        machine.add_word(f" {pattern.decode('latin-1')} ", (pattern.count(b" ") + 1, tuple(items)))
    if found:
        machine.make_automaton()
    return machine


def scan(text: bytes, machine: ahocorasick.Automaton) -> tuple[int, np.ndarray, set]:
    """(words of the text, flag for each word that is hit, ids of the items found)."""
    words = normal_words(text)
    line = f" {b' '.join(words).decode('latin-1')} "
    ends, counts, items = [], [], set()
    if len(machine):
        for end, (n, ids) in machine.iter(line):
            ends.append(end)
            counts.append(n)
            items.update(ids)
    hit = np.zeros(len(words), bool)
    if ends:
        # the space after word i is at the sum of the lengths of the words up to it and their spaces
        after = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        last = np.searchsorted(after, ends)
        step = np.zeros(len(words) + 1, np.int64)
        np.add.at(step, last - np.array(counts) + 1, 1)
        np.add.at(step, last + 1, -1)
        hit = np.cumsum(step[:-1]) > 0
    return len(words), hit, items


def character_spans(text: str, hit: np.ndarray) -> list[tuple[int, int]]:
    """Runs of hit words as character positions [from, to) of the original text."""
    raw = np.frombuffer(text.encode(), np.uint8)
    start, end, _ = tk.word_spans(tk.LOWER[raw], np.array([0, len(raw)]), tk.ALNUM)
    chars = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    edge = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    return [(int(chars[start[a]]), int(chars[end[b - 1]])) for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]


def benchmark_windows(benchmark: DataFrame, window: int, item_col: str, text_col: str) -> DataFrame:
    """Distinct (pattern, item) of the whole benchmark, as a stored table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found = list(dict.fromkeys(windows(text, window)))
                for a in range(0, len(found), 10_000):
                    part = found[a : a + 10_000]
                    yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([item] * len(part), pa.int64())], ["pattern", "item"])

    rows = benchmark.select(F.col(f"`{item_col}`").cast("long").alias("item"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return stored(in_arrow(rows, run, "pattern binary, item long").distinct(), "benchmark-windows")


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", keep_columns: tuple[str, ...] = (), spans: bool = False, block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated), with ``spans`` also the hit character spans.

    ``keep_columns`` of the documents are handed through.
    """
    own = dict(zip((id_col, *keep_columns), [f"own_{i}" for i in range(len(keep_columns) + 1)], strict=True))
    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), *[F.col(f"`{c}`").alias(o) for c, o in own.items()])
    context = docs.sparkSession.sparkContext
    known = benchmark_windows(benchmark, window, item_col, "text")
    n = known.count()
    n_blocks = max(1, -(-n // block_windows))

    def block(k: int) -> dict[bytes, set]:
        """About ``block_windows`` windows."""
        part = known.where(F.pmod(F.xxhash64("pattern", "item"), F.lit(n_blocks)) == k) if n_blocks > 1 else known
        out: dict[bytes, set] = defaultdict(set)
        for r in part.collect():
            out[bytes(r.pattern)].add(r.item)
        return dict(out)

    if n_blocks == 1:
        found = _scan_pass(rows, context.broadcast(block(0)), list(own.values()), spans)
    else:
        keyed = rows.withColumns({f"k{i}": F.xxhash64(F.lit(i), "text") for i in (1, 2)})
        hits = None
        for k in range(n_blocks):
            sent = context.broadcast(block(k))
            part = stored(_hits(keyed.select("text", "k1", "k2"), sent).dropDuplicates(["k1", "k2"]), "benchmark-hits")
            sent.destroy()
            hits = part if hits is None else hits.unionByName(part)
        # At most a row for each block and text.
        earlier = hits.groupBy("k1", "k2").agg(F.collect_list("hit").alias("hit"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
        found = _scan_pass(keyed.join(earlier, ["k1", "k2"], "left").drop("k1", "k2"), None, list(own.values()), spans)
    return found.select(*[F.col(o).alias(c) for c, o in own.items()], *found.columns[len(own) :])


_BUILT: dict = {}


def _machine(token: str, patterns_found: dict | None) -> ahocorasick.Automaton:
    """The worker's automaton, kept for its next tasks."""
    if _BUILT.get("token") != token:
        _BUILT.update(token=token, machine=automaton(patterns_found or {}))
    return _BUILT["machine"]


def _hits(rows: DataFrame, block) -> DataFrame:
    """(k1, k2, hit: packed flags of the words, items) of the texts that hold a window of the block."""
    token = uuid.uuid4().hex

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        machine = _machine(token, block.value)
        found = []
        for text, k1, k2 in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            n, hit, items = scan(text or b"", machine)
            if hit.any():
                found.append((k1, k2, np.packbits(hit).tobytes(), sorted(items - {None})))
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
        columns = zip(*found, strict=True) if found else ((), (), (), ())
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["k1", "k2", "hit", "items"])

    return map_slices(rows, run, "k1 long, k2 long, hit binary, items array<long>", "text")


def _scan_pass(rows: DataFrame, block, own: list[str], spans: bool) -> DataFrame:
    """The results, by one pass over the texts with a block's automaton or, without a block, from the hits found before, in the columns
    hit (packed flags of each block) and items."""
    token = uuid.uuid4().hex
    fields = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    if spans:
        fields += ", hit_spans array<struct<lo: int, hi: int>>"
    schema = rows.select(*own).schema
    for field in StructType.fromDDL(fields):
        schema = schema.add(field)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        machine = _machine(token, block.value if block else None)
        names = batch.schema.names
        earlier = None if block else zip(batch.column(names.index("hit")).to_pylist(), batch.column(names.index("items")).to_pylist(), strict=True)
        out: dict[str, list] = {f.name: [] for f in schema.fields[len(own) :]}
        for text in batch.column(0).cast(pa.binary()).to_pylist():
            n, hit, items = scan(text or b"", machine)
            if earlier:
                flags, known = next(earlier)
                for one in flags or ():
                    hit |= np.unpackbits(np.frombuffer(one, np.uint8), count=n).astype(bool)
                items.update(known or ())
            items = items - {None}
            n_hit, listed = int(hit.sum()), ",".join(sorted(map(str, items)))
            cells = (n, n_hit, len(items), hashlib.sha256(listed.encode()).hexdigest(), n_hit > 0 and 20 * n_hit >= n)
            if spans:
                cells += ([{"lo": a, "hi": b} for a, b in (character_spans((text or b"").decode(), hit) if n_hit else [])],)
            for name, cell in zip(out, cells, strict=True):
                out[name].append(cell)
        columns = [batch.column(names.index(c)) for c in own]
        kinds = to_arrow_schema(schema)
        return pa.RecordBatch.from_arrays([*columns, *(pa.array(v, kinds.field(k).type) for k, v in out.items())], schema.names)

    return map_slices(rows, run, schema, "text")
