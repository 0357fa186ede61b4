"""MinHash near-duplicates with odd-sketch verification of banded candidates (op8).

1. Every document becomes its set of distinct word shingles (64-bit hashes),
   ``HASHES`` MinHash samples, ``BANDS`` keys over ``ROWS`` samples each, and an
   odd sketch: every (sample number, sample) pair flips one of ``SKETCH_BITS``
   bits. The XOR of two sketches counts the samples in which two sets differ,
   with little noise at high similarity.
2. Documents with equal sets are one class (a partial aggregate), so a large
   group of copies costs one row per task from here on.
3. Classes that share a band key are candidates. First each class is compared
   with the smallest class of its bucket (as many pairs as rows); links found
   so give preliminary components. Then the buckets that still hold several
   components yield the other pairs across components. No bucket emits its
   pairs within a component, which is what a large group of near copies is.
   The rows outside a bucket's largest component ask, all its rows answer.
   Both are dealt to blocks of about ``BLOCK`` rows, and a cell is a block of
   askers with a block of answers: every pair across components meets in one
   cell, a cell is bounded, and a large family with a few outliers costs its
   rows about once.
4. A candidate survives if the sketches allow the threshold within
   ``SIGMAS`` deviations. A second odd sketch, folded from the whole set,
   bounds the symmetric difference from below (a differing bit needs a
   differing shingle), which rejects nearly all other pairs without a doubt.
   Survivors are confirmed on the full sets.
5. Components by contraction; the smallest id of a component is kept.

Two sets at similarity 0.8 share no band with a chance of 1.2e-7.

Defined cases: NULL or empty texts have the empty set, are their own
component and kept; fewer words than a shingle make the whole sequence the
one shingle; rows with a NULL id are linked with nothing, have a NULL
component and are kept; rows that share an id are one node of the graph and
all get its component; an empty table gives an empty result. Only the id and
the text are read, so other columns can't clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens as tk
from .common import clean_columns, in_arrow, list_column, map_slices, runs, shuffle_width, stored, utf8_buffers
from .graph import smallest_reachable

BANDS, ROWS = 40, 5
#: Samples of the odd sketch; the first BANDS * ROWS of them make the bands.
HASHES = 400
SKETCH_BITS = 2048
SIGMAS = 5.0
#: Rows of a block of a mixed bucket; a task holds one block that asks and one that answers.
BLOCK = 2048
#: Pairs of a cell compared in one step.
PAIRS = 1 << 15
#: Further members of a bucket with several components that all others are compared with.
PIVOTS = 6

_rng = np.random.Generator(np.random.PCG64(8))
_MUL = _rng.integers(0, 1 << 32, (HASHES, 1), dtype=np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, (HASHES, 1), dtype=np.uint32)
_SALT = _rng.integers(0, 1 << 62, HASHES, dtype=np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all rows one after the other, number of them for each row)."""
    w = tk.words(data, offsets, lower=True)
    counts = np.diff(w.offsets)
    grams = tk.gram_hashes(w.hash, n)
    row = w.doc[: len(grams)]
    ok = w.doc[n - 1 :] == row if len(grams) else np.empty(0, bool)
    grams, row = grams[ok], row[ok]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        whole = tk.span_hashes(w.hash, w.offsets[short], w.offsets[short + 1])
        grams, row = np.concatenate((grams, whole)), np.concatenate((row, short))
        order = np.argsort(row, kind="stable")
        grams, row = grams[order], row[order]
    start = np.searchsorted(row, np.arange(len(counts) + 1))
    sets = [np.unique(grams[a:b]) for a, b in zip(start[:-1].tolist(), start[1:].tolist(), strict=True)]
    return (np.concatenate(sets) if sets else grams), np.array([len(s) for s in sets], np.int64)


def signatures(members: np.ndarray, counts: np.ndarray, hashes: int = HASHES) -> np.ndarray:
    """MinHash samples (rows x hashes); rows with the empty set have zeros."""
    out = np.zeros((len(counts), hashes), np.uint32)
    low = (members >> np.uint64(32)).astype(np.uint32)
    ends = np.cumsum(counts)
    for i, (a, b) in enumerate(zip((ends - counts).tolist(), ends.tolist(), strict=True)):
        if b > a:
            best = None
            for c in range(a, b, 4096):  # bounded scratch for very long texts
                least = (_MUL[:hashes] * low[c : min(c + 4096, b)] + _ADD[:hashes]).min(axis=1)
                best = least if best is None else np.minimum(best, least)
            out[i] = best
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band (rows x BANDS), the band's number mixed in."""
    parts = samples[:, : BANDS * ROWS].reshape(len(samples), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(samples), BANDS)).copy()
    for k in range(ROWS):
        key = tk.mix(key * np.uint64(0xC2B2AE3D27D4EB4F) + parts[:, :, k])
    return key.view(np.int64)


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps (rows x SKETCH_BITS/8 bytes): each numbered sample flips one bit."""
    bit = (tk.mix(samples.astype(np.uint64) + _SALT) % np.uint64(SKETCH_BITS)).astype(np.int64)
    return _parity(np.arange(len(samples))[:, None] * SKETCH_BITS + bit, len(samples))


def set_sketches(members: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Parity bitmaps of whole sets (rows x SKETCH_BITS/8 bytes): each member flips one bit."""
    bit = (members % np.uint64(SKETCH_BITS)).astype(np.int64)
    return _parity(np.repeat(np.arange(len(counts)), counts) * SKETCH_BITS + bit, len(counts))


def _parity(at: np.ndarray, rows: int) -> np.ndarray:
    parity = np.bincount(at.ravel(), minlength=rows * SKETCH_BITS) & 1
    return np.packbits(parity.astype(np.uint8).reshape(rows, SKETCH_BITS), axis=1)


def possible(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, limit: int, percent: int) -> np.ndarray:
    """Which pairs of sketch rows (samples, then whole set; as 64-bit words) may reach the threshold; n, m: set sizes."""
    differ = np.bitwise_count(x ^ y)
    half = differ.shape[1] // 2
    both, apart = n + m, differ[:, half:].sum(axis=1, dtype=np.int64)
    return (differ[:, :half].sum(axis=1, dtype=np.int64) <= limit) & (100 * (both - apart) >= percent * (both + apart))


def sketch_limit(similarity: float) -> int:
    """Largest XOR population count that a pair at ``similarity`` has within SIGMAS deviations.

    The number of different samples is binomial; each puts two flips into the
    sketch, whose parity count varies by the flips that meet.
    """
    m, flips = SKETCH_BITS, 2 * HASHES * (1 - similarity)
    slope = math.exp(-2 * flips / m)
    mean = m / 2 * (1 - slope)
    spread = slope**2 * 4 * HASHES * similarity * (1 - similarity) + m / 4 * (1 - slope**2) - flips * slope**2
    return math.ceil(mean + SIGMAS * math.sqrt(spread))


def estimate(xor_count: np.ndarray) -> np.ndarray:
    """Similarity estimated from the XOR population count of two sketches."""
    share = np.minimum(2 * xor_count / SKETCH_BITS, 1 - 1e-9)
    return 1 + SKETCH_BITS / (4 * HASHES) * np.log1p(-share)


def _binary_rows(column: pa.Array, width: int) -> np.ndarray:
    if not len(column):
        return np.empty((0, width), np.uint8)
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width)


def _fixed(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1] if rows.ndim == 2 else 0
    raw = np.ascontiguousarray(rows).tobytes()
    return pa.array([raw[i * width : (i + 1) * width] for i in range(len(rows))], pa.binary())


def fingerprints(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n, set_a, set_b, sketch, bands) of every row; set_a and set_b are a 128-bit fingerprint of the set."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        members, counts = shingle_sets(*utf8_buffers(batch.column(1)), shingle)
        ends = np.cumsum(counts)
        set_a = tk.span_hashes(members, ends - counts, ends).view(np.int64)
        set_b = tk.span_hashes(tk.mix(members + np.uint64(77)), ends - counts, ends).view(np.int64)
        samples = signatures(members, counts)
        some = np.where(counts > 0, BANDS, 0)
        bands = list_column(band_keys(samples)[counts > 0].ravel(), some, pa.int64())
        columns = [batch.column(0), pa.array(counts), pa.array(set_a), pa.array(set_b), _fixed(np.hstack((odd_sketches(samples), set_sketches(members, counts)))), bands]
        return pa.RecordBatch.from_arrays(columns, ["id", "n", "set_a", "set_b", "sketch", "bands"])

    rows = clean_columns(docs, id_col, text_col).withColumn(id_col, F.col(f"`{id_col}`").cast("long"))
    schema = "id long, n long, set_a long, set_b long, sketch binary, bands array<long>"
    return map_slices(rows, run, schema, text_col)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that end with a group of ``key``, from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cut = int(runs(keys)[-2])
        if cut == 0 and held and held[-1].column(held[-1].schema.get_field_index(key))[-1].as_py() == keys[0].item():
            held.append(batch)
            continue
        done = [*held, batch.slice(0, cut)]
        if any(b.num_rows for b in done):
            yield pa.Table.from_batches(done).combine_chunks()
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def block_cells(labelled: DataFrame, rows: int) -> DataFrame:
    """Rows of mixed buckets dealt to cells of bounded size: (cell, hub, node, root, rest, asks, answers).

    rest: outside the bucket's largest component. Those rows are dealt to ``r`` blocks that ask, all rows to ``l``
    blocks that answer, and cell (i, j) holds asking block i and answering block j.
    """
    parts = labelled.groupBy("bucket", "root").agg(F.count("*").alias("rows"))
    shape = parts.groupBy("bucket").agg(F.max(F.struct("rows", "root")).alias("top"), F.sum("rows").alias("every"))
    blocks = lambda n: F.ceil(n / F.lit(rows)).cast("int")
    shape = shape.select(
        "bucket", F.col("top.root").alias("main"), blocks(F.col("every") - F.col("top.rows")).alias("r"), blocks(F.col("every")).alias("l")
    )
    block = lambda salt, n: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(n)).cast("int")
    dealt = labelled.join(shape, "bucket").select(
        "bucket", "hub", "node", "root", (F.col("root") != F.col("main")).alias("rest"), "r", "l", block(1, "r").alias("i"), block(2, "l").alias("j")
    )
    answers = F.transform(F.sequence(F.lit(0), F.col("r") - 1), lambda k: F.struct(k.alias("i"), F.col("j").alias("j")))
    asks = F.transform(F.sequence(F.lit(0), F.col("l") - 1), lambda k: F.struct(F.col("i").alias("i"), k.alias("j")))
    cells = dealt.withColumn("at", F.explode(F.when(F.col("rest"), F.array_union(answers, asks)).otherwise(answers)))
    return cells.select(
        F.xxhash64("bucket", "at.i", "at.j").alias("cell"), "hub", "node", "root", "rest",
        (F.col("rest") & (F.col("at.i") == F.col("i"))).alias("asks"), (F.col("at.j") == F.col("j")).alias("answers"),
    )


def cross_pairs(table: pa.Table, limit: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a row that asks and one that answers in its cell, in different components, that pass the size and the
    sketch test and don't hold the bucket's hub (those were compared before). The table holds whole cells, in order."""
    column = lambda c: table.column(c).to_numpy()
    hub, node, root, n, rest = (column(c) for c in ("hub", "node", "root", "n", "rest"))
    sketch = _binary_rows(table.column("sketch").combine_chunks(), SKETCH_BITS // 4).view(np.uint64)
    start = runs(column("cell"))
    cell = np.repeat(np.arange(len(start) - 1), np.diff(start))
    ask, answer = (np.flatnonzero(column(c) & (node != hub)) for c in ("asks", "answers"))
    first = np.searchsorted(cell[answer], cell[ask], "left")
    count = np.searchsorted(cell[answer], cell[ask], "right") - first
    ends = np.cumsum(count)
    us, vs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    a = 0
    while a < len(ask):
        before = int(ends[a] - count[a])
        b = max(a + 1, int(np.searchsorted(ends, before + PAIRS, "right")))
        i = np.repeat(ask[a:b], count[a:b])
        j = answer[np.repeat(first[a:b] - (ends[a:b] - count[a:b]), count[a:b]) + np.arange(before, ends[b - 1])]
        ok = (root[i] != root[j]) & (~rest[j] | (node[i] < node[j]))  # two that ask meet twice
        ok &= 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
        i, j = i[ok], j[ok]
        if len(i):
            near = possible(sketch[i], sketch[j], n[i], n[j], limit, percent)
            us.append(np.minimum(node[i[near]], node[j[near]]))
            vs.append(np.maximum(node[i[near]], node[j[near]]))
        a = b
    return np.concatenate(us), np.concatenate(vs)


def close_sketches(pairs: DataFrame, classes: DataFrame, limit: int, percent: int) -> DataFrame:
    """The pairs (u, v) that pass the size and the sketch tests; u < v."""
    side = lambda c: classes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}"))
    both = pairs.join(side("v"), "v").join(side("u"), "u").where(100 * F.least("n_u", "n_v") >= percent * F.greatest("n_u", "n_v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (_binary_rows(b.column(k), SKETCH_BITS // 4).view(np.uint64) for k in (2, 3))
            near = pa.array(possible(x, y, b.column(4).to_numpy(), b.column(5).to_numpy(), limit, percent))
            yield pa.RecordBatch.from_arrays([b.column(0).filter(near), b.column(1).filter(near)], ["u", "v"])

    return in_arrow(both.select("u", "v", "s_u", "s_v", "n_u", "n_v"), run, "u long, v long")


def full_sets(docs: DataFrame, wanted: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """(id, members) for the documents whose id is in ``wanted``; members: sorted shingle hashes."""

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        members, counts = shingle_sets(*utf8_buffers(batch.column(1)), shingle)
        raw, ends = members.tobytes(), np.cumsum(counts)
        cells = [raw[8 * a : 8 * b] for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(cells, pa.binary())], ["id", "members"])

    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return map_slices(texts.join(wanted, "id", "left_semi"), sets, "id long, members binary", "text")


def confirmed(pairs: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= percent * union."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(p, q), len(p) - 1)
                common = int((p[at] == q).sum()) if len(p) else 0
                keep.append(common > 0 and 100 * common >= percent * (len(p) + len(q) - common))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], ["u", "v"])

    side = lambda c: found.select(F.col("id").alias(c), F.col("members").alias(f"m_{c}"))
    both = pairs.join(side("v"), "v").join(side("u"), "u").select("u", "v", "m_u", "m_v")
    return in_arrow(both, compare, "u long, v long")


def _mixed(buckets: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Rows of the buckets that hold several components, with the component (root)."""
    if roots is None:
        labelled = buckets.withColumn("root", F.col("node"))
    else:
        labelled = buckets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = labelled.groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b").select("bucket")
    return stored(labelled.join(mixed, "bucket"), "mixed")


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", bucket: int = BLOCK
) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``docs``; bucket: rows of a block of a mixed bucket."""
    spark = docs.sparkSession
    limit = sketch_limit(percent / 100)
    rows = stored(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    classes = rows.where("n > 0 and id is not null").groupBy("set_a", "set_b").agg(
        F.min("id").alias("node"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands")
    )
    classes = stored(classes, "classes")

    members = classes.select("node", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("last"), F.count("*").alias("size"))
    buckets = stored(members.join(shared.where("hub < last").drop("last"), "bucket"), "buckets")

    hubs = buckets.where("node <> hub").select(F.col("hub").alias("u"), F.col("node").alias("v")).distinct()
    close = stored(close_sketches(hubs, classes, limit, percent), "close")
    found = stored(full_sets(docs, buckets.select(F.col("node").alias("id")).distinct(), shingle, id_col, text_col), "sets")
    same_id = rows.where("n > 0").groupBy("id").agg(F.min("set_a").alias("a"), F.max("set_a").alias("b")).where("a <> b").select("id")
    same_id = rows.join(same_id, "id").join(classes, ["set_a", "set_b"]).select(F.col("id").alias("u"), F.col("node").alias("v"))
    links = stored(confirmed(close, found, percent).union(same_id), "links")
    roots = smallest_reachable(links)

    # buckets with several components: first each class against some pivots, then the pairs left over
    labelled = _mixed(buckets.where("size > 2"), roots)
    chosen = [F.min_by("node", F.xxhash64("node", F.lit(k))).alias(f"p{k}") for k in range(PIVOTS)]
    pivots = labelled.groupBy("bucket").agg(*chosen).select("bucket", F.explode(F.array_distinct(F.array(*[f"p{k}" for k in range(PIVOTS)]))).alias("pivot"))
    pivots = pivots.join(labelled.select("bucket", F.col("node").alias("pivot"), F.col("root").alias("pivot_root")), ["bucket", "pivot"])
    probes = labelled.join(pivots, "bucket").where("root <> pivot_root").select(F.least("node", "pivot").alias("u"), F.greatest("node", "pivot").alias("v"))
    probes = stored(probes.distinct().join(close, ["u", "v"], "left_anti"), "probes")
    probed = stored(close_sketches(probes, classes, limit, percent), "close")
    more = stored(confirmed(probed, found, percent), "links")
    if not more.isEmpty():
        links = links.union(more)
        roots = smallest_reachable(links)
        labelled = _mixed(buckets.where("size > 2"), roots)
    cells = block_cells(labelled, bucket).join(classes.select("node", "n", "sketch"), "node")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "cell"):
            u, v = cross_pairs(t, limit, percent)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    dealt = cells.repartition(shuffle_width(spark), "cell").sortWithinPartitions("cell", "node")
    across = in_arrow(dealt, pairs, "u long, v long").distinct()
    across = stored(across.join(probed, ["u", "v"], "left_anti"), "across")
    more = stored(confirmed(across, found, percent), "links")
    if not more.isEmpty():
        roots = smallest_reachable(links.union(more))

    nodes = classes.select("set_a", "set_b", "node")
    if roots is None:
        nodes = nodes.withColumn("root", F.col("node"))
    else:
        nodes = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    out = rows.select("id", "n", "set_a", "set_b").join(nodes.drop("node"), ["set_a", "set_b"], "left")
    component = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("root")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
