"""Conflict-constrained best-fit packing of documents into bins of fixed token capacity (op2).

Documents are cut into pieces of at most ``capacity`` words; pieces go to bins
by best fit, decreasing. Open bins are kept in residual order. For a piece the
search starts at the successor of its size and walks on to larger residuals
until a bin carries neither the piece's source nor its duplicate cluster, which
is the tightest compatible bin; else a new bin is opened. Bins carry both sets
as bitmaps (Python integers), with bits numbered inside the packing group.

Packing is sequential, so documents are first dealt into groups by a hash of
their id, text checksum and source: every group has about ``group_rows``
documents whatever its sources, so a hot source or cluster is spread over all
groups and no task grows with the table. Rows that are equal in all that
packing reads are counted first and dealt in lots of ``LOT``, so a row that is
repeated without bound (or has no id and an empty text) is spread as well. Bins
never span groups.

Defined cases: NULL and empty texts have no words and get one piece of length
0 that still takes its source and cluster; a NULL source is a source of its
own and a NULL cluster conflicts with nothing; the pieces of one document have
the same source and cluster and so never share a bin; ties go by size, id,
text checksum, source and cluster, so the result doesn't depend on the input order; repeated
rows are packed each; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, stored
from .group_links import components
from .near_dedup import near_duplicates

CAPACITY = 2048
GROUP_ROWS = 4000
#: Equal rows that go to one packing group together.
LOT = 64
#: Rows repeated beyond that are told by a broadcast if there are at most so many different ones, else by a join.
FEW = 10_000

WORD = r"[^ \t-\r]+"
PACKED = "id long, no_id boolean, piece long, first_word long, n_words long, packing_group long, bin long, bin_offset long"


class Bins:
    """Open bins in residual order with their conflict bitmaps."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.order: list[tuple[int, int]] = []  # (residual, bin)
        self.sources: list[int] = []
        self.clusters: list[int] = []

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """The bin and the offset in it. source, cluster: bitmaps with one bit or none."""
        i = bisect_left(self.order, (size, -1))
        while i < len(self.order):
            residual, b = self.order[i]
            if not (self.sources[b] & source or self.clusters[b] & cluster):
                break
            i += 1
        if i == len(self.order):
            residual, b = self.capacity, len(self.sources)
            self.sources.append(0)
            self.clusters.append(0)
        else:
            del self.order[i]
        self.sources[b] |= source
        self.clusters[b] |= cluster
        insort(self.order, (residual - size, b))
        return b, self.capacity - residual


def pack_group(group: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Pieces of one packing group with bin and offset; a row stands for ``copies`` equal ones."""
    group = group.loc[group.index.repeat(group["copies"])]
    words = group["n_words"].to_numpy(np.int64)
    n_pieces = np.maximum(1, -(-words // capacity))
    at = np.repeat(np.arange(len(group)), n_pieces)
    piece = np.arange(len(at)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
    size = np.minimum(capacity, words[at] - piece * capacity)
    source = pd.factorize(group["source"], sort=True)[0][at] + 1
    cluster = pd.factorize(group["cluster"], sort=True)[0]
    shared = np.bincount(cluster[cluster >= 0], minlength=1)
    # a cluster with one piece can't conflict: it needs no bit
    bits = np.where((cluster >= 0) & ((shared[cluster] > 1) | (n_pieces > 1)), cluster, -1)
    bits = pd.factorize(np.where(bits < 0, np.nan, bits))[0][at]
    ids, no_id, crc = (group[c].to_numpy() for c in ("id", "no_id", "crc"))
    bins, bin_of, offset = Bins(capacity), np.empty(len(at), np.int64), np.empty(len(at), np.int64)
    for i in np.lexsort((piece, cluster[at], source, crc[at], ids[at], no_id[at], -size)).tolist():
        bin_of[i], offset[i] = bins.place(int(size[i]), 1 << int(source[i]), 1 << int(bits[i]) if bits[i] >= 0 else 0)
    return pd.DataFrame(
        {"id": ids[at], "no_id": no_id[at], "piece": piece, "first_word": piece * capacity, "n_words": size, "packing_group": group["packing_group"].to_numpy()[at], "bin": bin_of, "bin_offset": offset}
    )


def node_of(id_col: str, text_col: str = "text") -> Column:
    """The id, or for rows without one a hash of the text in its place."""
    return F.coalesce(F.col(f"`{id_col}`").cast("long"), F.xxhash64(F.lit("no id"), F.col(f"`{text_col}`")))


def near_clusters(docs: DataFrame, shingle: int, percent: int, id_col: str = "doc_id") -> DataFrame:
    """(node, cluster): the near-duplicate component of each document with words, those without an id too."""
    texts = docs.select(node_of(id_col).alias("node"), F.col("text"))
    found = near_duplicates(texts, shingle=shingle, percent=percent, id_col="node")
    return stored(found.where("n_shingles > 0").groupBy("node").agg(F.min("component_id").alias("cluster")), "clusters")


def pack(
    docs: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, cluster: str | None = None, id_col: str = "doc_id",
    clusters: DataFrame | None = None, lot: int = LOT, near: tuple[int, int] | None = None,
) -> DataFrame:
    """(id, piece, first_word, n_words, packing_group, bin, bin_offset) for every piece of every document.

    ``cluster`` names a column with the duplicate cluster; without it,
    documents with equal texts are a cluster. ``clusters`` (node, cluster) has
    the clusters of the documents with words by their ``node_of``. ``near`` =
    (words of a shingle, percent) takes the near-duplicate components within
    each packing group.
    """
    if near:
        return _pack_near(docs, capacity, group_rows, id_col, lot, near)
    text = F.coalesce(F.col("text"), F.lit(""))
    groups = max(1, -(-docs.count() // group_rows))
    crc = F.crc32(F.encode(text, "UTF-8"))
    rows = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(0)).alias("id"),
        F.col(f"`{id_col}`").isNull().alias("no_id"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"),
        F.col("source").cast("string").alias("source"),
        (F.col(f"`{cluster}`").cast("string") if cluster else F.when(F.col("text").isNotNull(), F.md5(F.encode(text, "UTF-8")))).alias("cluster"),
        crc.alias("crc"),
        *([node_of(id_col).alias("node")] if clusters is not None else []),
    )
    if clusters is not None:
        known = clusters.select("node", F.col("cluster").cast("string").alias("known"))
        near = F.when(F.col("n_words") > 0, F.col("known"))
        rows = rows.join(known, "node", "left").withColumn("cluster", F.coalesce(near, "cluster")).drop("node", "known")
    rows = rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))
    rows = rows.withColumn("nth", F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {lot}")))).select(
        *[c for c in rows.columns if c != "n"], F.least(F.col("n") - F.col("nth") * lot, F.lit(lot)).cast("long").alias("copies"),
        F.pmod(F.xxhash64("no_id", "id", "crc", "source", "nth"), F.lit(groups)).alias("packing_group"),
    )
    ship(docs.sparkSession)
    packed = rows.groupBy("packing_group").applyInPandas(lambda g: pack_group(g, capacity), PACKED)
    return packed.select(
        F.when(~F.col("no_id"), F.col("id")).alias(id_col), "piece", "first_word", "n_words", "packing_group", "bin", "bin_offset"
    )


def _pack_near(docs: DataFrame, capacity: int, group_rows: int, id_col: str, lot: int, near: tuple[int, int]) -> DataFrame:
    """``pack`` with near-duplicate components. Every text is shuffled once, to its packing group, and linked there."""
    text = F.col("text").cast("string")
    rows = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(0)).alias("id"), F.col(f"`{id_col}`").isNull().alias("no_id"),
        F.col("source").cast("string").alias("source"), text.alias("text"),
    )
    groups = max(1, -(-docs.count() // group_rows))
    rows = rows.withColumns({f"k{i}": F.xxhash64(F.lit(i), "no_id", "id", F.col("source").isNull(), "source", F.col("text").isNull(), "text") for i in (1, 2)})
    often = stored(rows.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > lot), "repeated")
    told = F.broadcast(often) if often.count() <= FEW else often
    single = rows.join(told, ["k1", "k2"], "left_anti").withColumns({"copies": F.lit(1).cast("long"), "nth": F.lit(0).cast("long")})
    # Of rows repeated without bound one stands for each lot.
    light = ["k1", "k2", "id", "no_id", "source", "n"]
    many = rows.join(told, ["k1", "k2"]).groupBy(*light).agg(F.any_value("text").alias("text"))
    many = many.withColumn("nth", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {lot}"))))
    many = many.withColumn("copies", F.least(F.col("n") - F.col("nth") * lot, F.lit(lot)).cast("long"))
    dealt = single.unionByName(many.select(*single.columns))
    dealt = dealt.withColumn("packing_group", F.pmod(F.xxhash64("k1", "k2", "nth"), F.lit(groups))).drop("nth", "k1", "k2")
    dealt = dealt.select(
        "packing_group", "id", "no_id", "source", "copies", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("n_words"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("crc"), "text",
    )

    def of_group(t: pa.Table) -> pa.Table:
        texts = t["text"].combine_chunks()
        linked = components(texts, *near)
        own = texts.to_pylist()
        # Texts without words are clusters of equal ones, as without ``near``; names keep the ties' order.
        names = [None if x is None else f"n{c:09}" if c >= 0 else f"t{x}" for c, x in zip(linked.tolist(), own, strict=True)]
        frame = t.drop_columns("text").to_pandas()
        frame["cluster"] = pd.Series(names, dtype=object)
        return pa.Table.from_pandas(pack_group(frame, capacity), preserve_index=False)

    ship(docs.sparkSession)
    packed = dealt.groupBy("packing_group").applyInArrow(of_group, PACKED)
    return packed.select(F.when(~F.col("no_id"), F.col("id")).alias(id_col), "piece", "first_word", "n_words", "packing_group", "bin", "bin_offset")
