"""Removal of passages that an earlier document has, by sharded FM-indexes (op5).

A window is ``WINDOW`` consecutive words. Its anchor is the smallest hash of
its ``GRAM``-word grams, so equal windows have equal anchors wherever they
stand; neighbouring windows with one anchor form a segment (about 20 windows).

1. One pass over the texts writes each document's segments: place, anchor and
   fingerprint, no words. A partial aggregate finds the anchors that occur in
   two documents or more; only their segments go on.
2. Equal segments are one class with its smallest document (pre-aggregated,
   so a passage that a third of all documents share costs a row per task).
   Every later document loses such a segment whole. What is left to settle is
   if the smallest document's own segment has windows of other, earlier ones.
3. For that the classes of an anchor are ordered by their smallest document:
   all but the last may be copied from and are indexed, all but the first may
   be copies and are streamed. Their words are taken from the texts of the
   smallest documents and dealt to shards by a hash of the anchor; the number
   of shards follows from the words. Each shard builds one run-length FM-index
   and streams the later documents' segments through it: backward search gives
   for every window the group of indexed suffixes that share it, and by that
   the smallest document that has it.
4. An anchor with over ``HOT`` classes (the edges of a passage that very many
   documents share, each followed by words of its own) would make a shard of
   its own without a bound. It is divided further by all words of its windows:
   each is dealt out by a 128-bit fingerprint, which leaves nothing to search,
   and its smallest document found by aggregation.
5. The intervals found meet all places of their segment in its smallest
   document, and all intervals of a document meet its text in one join.

Joins that put rows to their anchor or class broadcast the groups that hold
over a ``WIDE``-th of all rows, of which there are fewer than ``WIDE``; the
others are shuffled, so no task gets more than that of one group.

Defined cases: NULL, empty and short texts (under WINDOW words) lose nothing;
windows are judged on the input, so chains of copies all go but the first;
rows with a NULL id are left as they are and are no earlier document for
others; rows with equal ids aren't earlier than each other; repeated rows
give repeated results; an empty table gives an empty result; only id and text
are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens as tk
from .common import in_arrow, list_column, map_slices, runs, ship, stored, utf8_buffers
from .fm_index import FMIndex

WINDOW = 50
GRAM = 8
#: A segment holds so many windows at most; a longer run of one anchor is cut.
SEGMENT = 128
SHARD_WORDS = 250_000
HOT = 1000
#: Groups with more than this part of all rows are joined by broadcast; there can't be as many as this.
WIDE = 2000


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def segments(w: tk.Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, first word in the row, windows, anchor, fingerprint) of all segments of a slice."""
    gram = min(GRAM, window)
    n = len(w.hash) - window + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 5
    anchors = sliding_min(tk.gram_hashes(w.hash, gram), window - gram + 1)
    at = np.flatnonzero(w.doc[:n] == w.doc[window - 1 :])
    anchor = anchors[at]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (anchor[1:] != anchor[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(at)))
    pieces = -(-size // SEGMENT)
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first, size = np.repeat(first, pieces) + nth * SEGMENT, np.minimum(SEGMENT, np.repeat(size, pieces) - nth * SEGMENT)
    start = at[first]
    row = w.doc[start]
    return row, start - w.offsets[row], size, anchor[first], tk.span_hashes(w.hash, start, start + size + window - 1)


def _ids(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, rid, text): rid stands for (id, text), so equal rows share it."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc"),
        F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("rid"),
        F.col(f"`{text_col}`").alias("text"),
    )


def document_segments(rows: DataFrame, window: int) -> DataFrame:
    """(doc, rid, first, windows, anchor, segment), a row for each segment; rows with one rid count once."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        w = tk.words(*utf8_buffers(batch.column(2)))
        row, first, size, anchor, mark = segments(w, window)
        counts = np.bincount(row, minlength=batch.num_rows)
        lists = [(first, pa.int32()), (size, pa.int32()), (anchor.view(np.int64), pa.int64()), (mark.view(np.int64), pa.int64())]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *(list_column(v, counts, kind) for v, kind in lists)],
            ["doc", "rid", "first", "windows", "anchor", "segment"],
        )

    schema = "doc long, rid long, first array<int>, windows array<int>, anchor array<long>, segment array<long>"
    lists = map_slices(rows.where("doc is not null"), run, schema, "text").where(F.size("first") > 0)
    lists = stored(lists.dropDuplicates(["rid"]), "segments")
    return lists.select("doc", "rid", F.inline(F.arrays_zip("first", "windows", "anchor", "segment")))


def attach(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """``rows`` that have a group in ``groups``, with its columns; ``size`` counts a group's rows, ``total`` all rows."""
    cut = total // WIDE
    own = [c for c in groups.columns if c not in keys]
    wide = groups.where(F.col(size) > cut).withColumn("wide", F.lit(True))
    marked = rows.join(F.broadcast(wide), keys, "left")
    rest = marked.where("wide is null").drop("wide", *own).join(groups.where(F.col(size) <= cut), keys)
    return marked.where("wide").drop("wide").unionByName(rest)


def segment_words(rows: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """Words of the wanted segments (hot = false), and two fingerprints of each window of the hot ones, from the texts.

    wanted: rid, asked: array of (first, windows, anchor, segment, indexed, streamed, hot).
    """
    schema = "hot boolean, indexed boolean, streamed boolean, doc long, anchor long, segment long, at int, one long, two long, words binary"
    asked_columns = ("first", "windows", "anchor", "segment", "indexed", "streamed", "hot")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        w = tk.words(*utf8_buffers(batch.column(2)))
        asked = batch.column(3)
        flat = asked.flatten()
        row = np.repeat(np.arange(batch.num_rows), np.diff(asked.offsets.to_numpy()))
        first, size, anchor, mark, indexed, streamed, hot = (flat.field(c).to_numpy(zero_copy_only=False) for c in asked_columns)
        start = w.offsets[row] + first
        cold, many = np.flatnonzero(~hot), np.flatnonzero(hot)
        cells = [w.hash[a:b].tobytes() for a, b in zip(start[cold].tolist(), (start + size + window - 1)[cold].tolist(), strict=True)]
        nth = np.arange(size[many].sum()) - np.repeat(np.cumsum(size[many]) - size[many], size[many])
        place = np.repeat(start[many], size[many]) + nth
        one = tk.span_hashes(w.hash, place, place + window).view(np.int64)
        two = tk.span_hashes(tk.mix(w.hash + np.uint64(5)), place, place + window).view(np.int64)
        of = np.concatenate((cold, np.repeat(many, size[many])))
        none = np.zeros(len(cold), np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(hot[of], pa.bool_()), pa.array(indexed[of], pa.bool_()), pa.array(streamed[of], pa.bool_()),
                batch.column(0).take(pa.array(row[of])), pa.array(anchor[of], pa.int64()), pa.array(mark[of], pa.int64()),
                pa.array(np.concatenate((none, nth)), pa.int32()),
                pa.array(np.concatenate((none, one)), pa.int64()), pa.array(np.concatenate((none, two)), pa.int64()),
                pa.array(cells + [None] * len(place), pa.binary()),
            ],
            ["hot", "indexed", "streamed", "doc", "anchor", "segment", "at", "one", "two", "words"],
        )

    once = rows.where("doc is not null").join(wanted, "rid").dropDuplicates(["rid"])
    return map_slices(once.select("doc", "rid", "text", "asked"), run, schema, "text")


def _joined_words(shard: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes of all segments, start and end of each)."""
    cells = [x.as_buffer() for x in shard.column("words")]
    end = np.cumsum([x.size // 8 for x in cells], dtype=np.int64)
    return np.frombuffer(b"".join(cells), np.uint64), np.append(0, end[:-1]), end


def search_shard(shard: pa.Table, window: int) -> pa.Table:
    """Index a shard's segments marked so, stream the others marked so through the index, and give for each the runs
    of windows that a smaller document has: (anchor, segment, doc, from, to)."""
    indexed, streamed = shard.filter(shard.column("indexed")), shard.filter(shard.column("streamed"))
    if not (indexed.num_rows and streamed.num_rows):
        at, of, first, last = (np.empty(0, np.int64),) * 4
    else:
        words, start, end = _joined_words(indexed)
        kinds, symbols = np.unique(words, return_inverse=True)
        index = FMIndex(symbols, start, len(kinds), window, indexed.column("doc").to_numpy())
        words, start, end = _joined_words(streamed)
        near = np.minimum(np.searchsorted(kinds, words), len(kinds) - 1)
        group = index.windows(np.where(kinds[near] == words, near, -1), start, end)
        owner = np.repeat(np.arange(len(start)), end - start)
        at = np.flatnonzero((group >= 0) & (index.least[group] < streamed.column("doc").to_numpy()[owner]))
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at))[: len(first)] - 1
        of = owner[at[first]]
        first, last = at[first] - start[of], at[last] - start[of] + 1
    found = streamed.select(["anchor", "segment", "doc"]).take(pa.array(of))
    return found.append_column("from", pa.array(first, pa.int32())).append_column("to", pa.array(last, pa.int32()))


def repeated_spans(rows: DataFrame, window: int = WINDOW, hot: int = HOT, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(rid, spans): word intervals [lo, hi) of each document that an earlier document has."""
    spark = rows.sparkSession
    every = document_segments(rows, window)
    anchors = every.groupBy("anchor").agg(F.min("doc").alias("a"), F.max("doc").alias("b"), F.count("*").alias("n")).where("a < b")
    shared = stored(anchors.select("anchor", "n"), "shared-anchors")
    places = stored(attach(every, shared, ["anchor"], "n", every.count()).drop("n"), "shared-segments")

    head = F.min(F.struct("doc", "rid", "first", "windows")).alias("head")
    classes = places.groupBy("anchor", "segment").agg(head, F.max("doc").alias("last"), F.count("*").alias("n"))
    classes = stored(classes.select("anchor", "segment", "last", "n", "head.*"), "segment-classes")
    order = classes.groupBy("anchor").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.count("*").alias("kinds")).where("lo < hi")
    order = stored(order, "anchor-orders")
    dealt = attach(classes.drop("last", "n"), order, ["anchor"], "kinds", classes.count())
    role = F.struct("first", "windows", "anchor", "segment", F.expr("doc < hi").alias("indexed"), F.expr("doc > lo").alias("streamed"), (F.col("kinds") > hot).alias("hot"))
    wanted = dealt.groupBy("rid").agg(F.collect_list(role).alias("asked"))
    pieces = stored(segment_words(rows, wanted, window), "segment-words")

    ship(spark)
    cold = pieces.where("not hot").select("doc", "anchor", "segment", "indexed", "streamed", "words")
    total = cold.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    shards = max(1, -(-total // (8 * shard_words)))
    searched = (
        cold.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).groupBy("shard")
        .applyInArrow(lambda t: search_shard(t, window), "anchor long, segment long, doc long, from int, to int")
    )
    windows = pieces.where("hot").select("doc", "anchor", "segment", "at", "one", "two")
    least = windows.groupBy("one", "two").agg(F.min("doc").alias("least"), F.max("doc").alias("b"), F.count("*").alias("n")).where("least < b")
    least = stored(least.drop("b"), "window-classes")
    single = attach(windows, least, ["one", "two"], "n", windows.count()).where("least < doc")
    single = single.select("anchor", "segment", "doc", F.col("at").alias("from"), (F.col("at") + 1).alias("to"))
    found = stored(searched.unionByName(single), "segment-runs")

    own = places.join(found, ["anchor", "segment", "doc"]).select(
        "rid", (F.col("first") + F.col("from")).alias("lo"), (F.col("first") + F.col("to") + (window - 1)).alias("hi")
    )
    copied = classes.where("doc < last").select("anchor", "segment", F.col("doc").alias("least"), "n")
    whole = attach(places, copied, ["anchor", "segment"], "n", places.count()).where("least < doc").select(
        "rid", F.col("first").alias("lo"), (F.col("first") + F.col("windows") + (window - 1)).alias("hi")
    )
    return own.union(whole).groupBy("rid").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_columns: tuple[str, ...] = (), window: int = WINDOW,
    hot: int = HOT, shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) for every row; with ``keep_columns`` also these and ``kept_text``
    (unchanged where nothing was removed, else the kept words joined by one space)."""
    spans = repeated_spans(_ids(docs, id_col, text_col), window, hot, shard_words)
    named = {c: f"own_{i}" for i, c in enumerate(keep_columns)}
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc"), F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("rid"),
        F.col(f"`{text_col}`").alias("text"), *[F.col(f"`{c}`").alias(own) for c, own in named.items()],
    )
    joined = rows.join(spans, "rid", "left").drop("rid")
    schema = rows.select("doc", *named.values()).schema
    for part in ("n_words long", "n_removed long", "kept_sha256 string", *(["kept_text string"] if named else [])):
        schema = schema.add(*part.split())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = lambda c: batch.column(batch.schema.get_field_index(c))
        marks = column("spans").to_pylist()
        texts = column("text").cast(pa.binary()).to_pylist()
        n_words, n_removed, digest, kept_text = [], [], [], []
        for text, spans in zip(texts, marks, strict=True):
            words = (text or b"").split()  # splits at exactly the six separators
            n_words.append(len(words))
            if spans:
                step = np.zeros(len(words) + 1, np.int64)
                np.add.at(step, [s["lo"] for s in spans], 1)
                np.add.at(step, [s["hi"] for s in spans], -1)
                left = (np.cumsum(step[:-1]) == 0).tolist()
                words = [x for x, ok in zip(words, left, strict=True) if ok]
            n_removed.append(n_words[-1] - len(words))
            whole = b" ".join(words)
            digest.append(hashlib.sha256(whole).hexdigest())
            if named:
                kept_text.append(whole.decode("utf-8", "replace") if spans else text and text.decode("utf-8", "replace"))
        columns = [column("doc"), *(column(c) for c in named.values()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digest, pa.string())]
        columns += [pa.array(kept_text, pa.string())] if named else []
        return pa.RecordBatch.from_arrays(columns, schema.names)

    out = map_slices(joined, run, schema, "text")
    return out.select(F.col("doc").alias(id_col), *[F.col(own).alias(c) for c, own in named.items()], *out.columns[1 + len(named) :])
