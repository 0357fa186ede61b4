"""Trie of the turn sequences of conversations from padded turn-id matrices (op11).

A node is a distinct sequence of first turns; its members are the conversations that start with it. A range partition of
the conversations by their turn-id sequences is a shard: a padded matrix, ordered by numpy's lexsort. The change masks
of its columns (does the turn differ from the row above?), OR-accumulated from left to right, mark at every depth the
rows where a node starts; reduceat between the marks sums members, children, leaves and saved tokens of all
nodes of the depth. Sums over a subtree need no recursion: a row adds the words of the turns at which it opens no node, and a
leaf is counted by its last row.

Only nodes on the path of a shard's first or last row can go on in another shard. They leave the shard as partial sums,
with the row at either edge; how far the last row of the shard before agrees with the first row says what was counted
twice, and the partial sums of a node recombine by its key. All others are whole and aren't shuffled again.

At scale: turns are numbered by a range partition on (conversation, turn), so that a conversation may span tasks; sequences are cut into segments of
``SEGMENT`` turns, each placed below its node by a hash of all turns before it, so that no row
grows with a conversation; the members that end in a boundary node are hashed in one streaming pass, in order, from pieces. A shard is
about ``SHARD`` segments, whatever the copies: the order ends in the conversation's id. Turns are compared by 126 bits of hash.

Defined cases: NULL role or text is empty; rows without a conversation id take no part; rows of one turn number (NULL
first) are ordered by role, the first 256 characters and the hash of the text; repeated rows are turns of their own; a
conversation that the rebuild leaves without turns is a member of the root; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import clean_columns, in_arrow, shuffle_width, stored
from .tokens import mix

SEGMENT = 32
SHARD = 1 << 17
#: Segments of a conversation whose running values are summed in one group.
GROUP = 4096
#: Characters of a piece of a member list.
PIECE = 16_000
KEY = ["depth", "p1", "p2", "q1", "q2"]
SUMS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]


# --- turns, numbered and rebuilt -------------------------------------------------------------------------------------
def _numbered(conversations: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """Turns (conv, part, mid, a, b, words) in order and, for each conversation and part of it, where it starts."""
    rows = clean_columns(conversations, id_col, "turn", "role", "text").toDF("conv", "turn", "role", "text")
    rows = rows.where(F.col("conv").isNotNull()).select(
        F.col("conv").cast("long").alias("conv"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    positive = F.lit((1 << 63) - 1)
    turns = rows.select(
        "conv", "turn", "role", F.left("text", F.lit(256)).alias("head"),
        F.xxhash64(F.lit(1), "role", "text").bitwiseAND(positive).alias("a"), F.xxhash64(F.lit(2), "role", "text").bitwiseAND(positive).alias("b"),
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "head", "a", "b"]
    spread = turns.repartitionByRange(shuffle_width(turns.sparkSession), *order).sortWithinPartitions(*order)
    turns = stored(spread.select("conv", "a", "b", "words", F.monotonically_increasing_id().alias("mid")), "trie-turns")
    turns = turns.withColumn("part", F.shiftright("mid", 33))
    parts = turns.groupBy("conv", "part").agg(F.min("mid").alias("start"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part")  # a row for each part that holds turns of the conversation
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return turns, stored(parts.withColumn("total", F.sum("n").over(Window.partitionBy("conv"))), "trie-parts")


def _rebuilt(turns: DataFrame, parts: DataFrame, share: tuple[int, int] | None) -> tuple[DataFrame, DataFrame]:
    """Turns (conv, pos, a, b, words, total) and all conversations (conv, total). With ``share`` = (group, most), a conversation's first
    h = crc32(conv) mod ``most`` turns are those of conversation conv - conv % group, as far as it has them."""
    at = (F.col("mid") - F.col("start") + F.col("before")).alias("pos")
    if share is None:
        own = turns.join(parts, ["conv", "part"]).select("conv", at, "a", "b", "words", "total")
        return own, parts.where("before = 0").select("conv", "total")
    group, most = share
    base = F.col("conv") - F.col("conv") % group
    heads = turns.where(F.col("conv") == base).join(parts, ["conv", "part"]).select("conv", at, "a", "b", "words").where(F.col("pos") < most - 1)
    heads = heads.groupBy(F.col("conv").alias("base")).agg(F.sort_array(F.collect_list(F.struct("pos", "a", "b", "words"))).alias("head"))
    asked = F.when(F.col("conv") == base, F.lit(0)).otherwise(F.crc32(F.col("conv").cast("string").cast("binary")) % most)
    parts = parts.withColumn("base", base).withColumn("h", asked).join(heads, "base", "left")
    got = F.least(F.col("h"), F.coalesce(F.size("head"), F.lit(0)).cast("long"))
    parts = parts.withColumn("got", got).withColumn("length", F.col("got") + F.greatest(F.col("total") - F.col("h"), F.lit(0)))
    convs = stored(parts.select("conv", "part", "start", "before", "h", "got", "length", F.when((F.col("before") == 0) & (F.col("got") > 0), F.slice("head", F.lit(1), F.col("got").cast("int"))).alias("head")), "trie-rebuilt")
    own = turns.join(convs, ["conv", "part"]).select("conv", at, "a", "b", "words", "h", "got", F.col("length").alias("total"))
    own = own.where("pos >= h").select("conv", (F.col("pos") - F.col("h") + F.col("got")).alias("pos"), "a", "b", "words", "total")
    copied = convs.where("head is not null").select("conv", F.col("length").alias("total"), F.explode("head").alias("t"))
    copied = copied.select("conv", "t.pos", "t.a", "t.b", "t.words", "total")
    return own.unionByName(copied), convs.where("before = 0").select("conv", F.col("length").alias("total"))


def _running(df: DataFrame, values: dict[str, Column], later: bool) -> DataFrame:
    """``df`` (conv, level, ...) with, for each named aggregate, its value over the conversation's earlier (or later) segments. Two
    steps, so that a conversation of very many segments isn't one group."""
    df = df.withColumn("g", F.floor(F.col("level") / GROUP))

    def rest(*keys: str, by: str) -> Window:
        w = Window.partitionBy(*keys).orderBy(F.desc(by) if later else by)
        return w.rowsBetween(Window.unboundedPreceding, -1)

    totals = df.groupBy("conv", "g").agg(*[v.alias(f"_{n}") for n, v in values.items()])
    for n, v in values.items():
        totals = totals.withColumn(f"_{n}", _over(v, f"_{n}", rest("conv", by="g")))
    out = df.join(totals, ["conv", "g"])
    for n, v in values.items():
        inner = _over(v, None, rest("conv", "g", by="level"))
        out = out.withColumn(f"{n}_rest", F.coalesce(inner, F.lit(0)).bitwiseXOR(F.coalesce(f"_{n}", F.lit(0))) if n.startswith("x") else F.coalesce(inner, F.lit(0)) + F.coalesce(f"_{n}", F.lit(0)))
    return out.drop("g", *[f"_{n}" for n in values])


def _over(value: Column, column: str | None, window) -> Column:
    if column is None:
        return value.over(window)
    return (F.bit_xor(column) if column.startswith("_x") else F.sum(column)).over(window)


def _segments(turns: DataFrame, convs: DataFrame, segment: int) -> DataFrame:
    """(conv, level, more, p1, p2, n1, n2, a, b, words): the turns of each segment, the hash of all turns before it and of those up to
    its end; conversations without turns have one empty segment."""
    rows = turns.withColumn("level", F.floor(F.col("pos") / segment)).groupBy("conv", "level").agg(
        F.sort_array(F.collect_list(F.struct("pos", "a", "b", "words"))).alias("t"), F.max("total").alias("total"),
        F.bit_xor(F.xxhash64(F.lit(3), "pos", "a", "b")).alias("x1"), F.bit_xor(F.xxhash64(F.lit(4), "pos", "a", "b")).alias("x2"),
    )
    rows = stored(rows, "trie-segments")
    cut = (F.col("level") + 1) * segment < F.col("total")
    lists = [F.col(f"t.{c}").alias(c) for c in ("a", "b", "words")]
    zero = F.lit(0).cast("long")
    short = rows.where(F.col("total") < segment).select("conv", "level", F.lit(False).alias("more"), *[zero.alias(c) for c in ("p1", "p2", "n1", "n2")], *lists)
    long = _running(rows.where(F.col("total") >= segment), {"x1": F.bit_xor("x1"), "x2": F.bit_xor("x2")}, later=False)
    long = long.select(
        "conv", "level", cut.alias("more"), F.col("x1_rest").alias("p1"), F.col("x2_rest").alias("p2"),
        F.col("x1").bitwiseXOR(F.col("x1_rest")).alias("n1"), F.col("x2").bitwiseXOR(F.col("x2_rest")).alias("n2"), *lists,
    )
    none = F.array().cast("array<long>")
    empty = convs.where("total = 0").select("conv", zero.alias("level"), F.lit(False).alias("more"), *[zero.alias(c) for c in ("p1", "p2", "n1", "n2")], *[none.alias(c) for c in ("a", "b", "words")])
    return stored(short.unionByName(long).unionByName(empty), "trie-rows")


# --- shards --------------------------------------------------------------------------------------------------------
class Shard:
    """The matrices of one range partition, ordered, with the marks where nodes start."""

    def __init__(self, t: pa.Table):
        lists = {c: t[c].combine_chunks() for c in ("a", "b", "words")}
        counts = lists["a"].value_lengths().to_numpy()
        n, width = t.num_rows, int(counts.max(initial=0))
        at = np.arange(width)[None] < counts[:, None]
        m = {}
        for c, column in lists.items():
            m[c] = np.full((n, width), 0 if c == "words" else -1, np.int64)
            m[c][at] = column.flatten().to_numpy()
        one = {c: t[c].to_numpy() for c in ("conv", "level", "more", "p1", "p2", "n1", "n2", "carry_saved", "carry_leaves")}
        keys = [one["conv"], one["more"]]
        for j in range(width - 1, -1, -1):
            keys += [m["b"][:, j], m["a"][:, j]]
        order = np.lexsort([*keys, one["p2"], one["p1"], one["level"]])
        self.a, self.b, self.words = (m[c][order] for c in ("a", "b", "words"))
        self.one = {c: x[order] for c, x in one.items()}
        self.length, self.n, self.width = counts[order].astype(np.int64), n, width
        differs = np.zeros((n, width + 1), bool)
        differs[0, 0] = True
        for c in ("level", "p1", "p2"):
            differs[1:, 0] |= self.one[c][1:] != self.one[c][:-1]
        differs[1:, 1:] = (self.a[1:] != self.a[:-1]) | (self.b[1:] != self.b[:-1])
        self.new = np.logical_or.accumulate(differs, axis=1)
        #: Has a row a turn at each depth (its node there)?
        self.deep = np.arange(width + 1)[None] <= self.length[:, None]
        # Words of the turns at which a row opens no node, from each depth on.
        self.again = np.zeros((n, width + 1), np.int64)
        self.again[:, 1:] = np.where(self.deep[:, 1:] & ~self.new[:, 1:], self.words, 0)
        extended = np.zeros(n, bool)
        extended[:-1] = ~self.new[np.arange(1, n), self.length[:-1]]
        self.leaf = ~self.one["more"] & ~extended

    def key_hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash of a row's turns up to each depth within the segment, twice 64 bits."""
        out = []
        for k, ids in enumerate((self.a, self.b)):
            salt = mix(np.arange(1, self.width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * k))
            h = np.zeros((self.n, self.width + 1), np.uint64)
            h[:, 1:] = np.bitwise_xor.accumulate(mix(ids.astype(np.uint64) ^ salt[None]), axis=1)
            out.append(h.view(np.int64))
        return out[0], out[1]


def _hex(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


NODE = (
    "kind string, part int, depth long, p1 long, p2 long, q1 long, q2 long, s1 long, s2 long, u1 long, u2 long, conv long, parent long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends string, first boolean, last boolean, local int, piece int"
)
_NODE = [x.split() for x in NODE.split(", ")]
_KIND = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_()}


def _batch(columns: dict, n: int) -> pa.RecordBatch:
    out = []
    for name, kind in _NODE:
        x = columns.get(name)
        if x is None or isinstance(x, (str, int, bool)):
            x = [x] * n
        out.append(pa.array(x, _KIND[kind]))
    return pa.RecordBatch.from_arrays(out, [n for n, _ in _NODE])


def _nodes(s: Shard, part: int, segment: int):
    """Whole nodes ("node"), partial sums of boundary nodes ("part"), the pieces of their member lists ("ends").
    A node's key is its depth, the hash of all turns before its segment (p1, p2) and that of its turns within it (q1, q2); at a
    segment's end the next one's (p1, p2) and zeros. Its parent's key is (depth - 1, s1, s2, u1, u2)."""
    h1, h2 = s.key_hashes()
    one = s.one
    carry = one["carry_saved"]
    later = np.cumsum(s.again[:, ::-1], axis=1)[:, ::-1] + carry[:, None]
    leaves = s.leaf.astype(np.int64) + one["carry_leaves"]
    end = ~one["more"]
    # Rows that end in one node are neighbours, in order of their ids.
    same = np.zeros(s.n, bool)
    same[1:] = end[1:] & end[:-1] & (s.length[1:] == s.length[:-1]) & ~s.new[np.arange(1, s.n), s.length[1:]]
    parent = None
    for d in range(s.width + 1):
        start = np.flatnonzero(s.new[:, d])
        stop = np.append(start[1:], s.n)
        least = np.minimum.reduceat(one["conv"], start)
        node = s.deep[start, d]  # else rows that ended before
        below = s.new[:, d + 1] & s.deep[:, d + 1] if d < s.width else np.zeros(s.n, bool)
        children = np.add.reduceat(below.astype(np.int64), start)
        kids, last_leaf = np.add.reduceat(leaves, start), np.add.reduceat(later[:, d], start)
        ends_here = end & (s.length == d)
        n_ends = np.add.reduceat(ends_here.astype(np.int64), start)
        first, last = start == 0, stop == s.n
        level = one["level"][start]
        top = (d == 0) & (level > 0)  # the node is the last one of the segment before; only its children are known here
        full = np.full(len(start), d == segment)
        partial = (first | last | full | (d == 0)) & node
        whole = node & ~partial
        above = np.searchsorted(parent[0], start, "right") - 1 if d else None
        if whole.any():
            i = np.flatnonzero(whole)
            pending = parent[2][above[i]]
            sha = [_hex(one["conv"][a : a + m].tolist()) for a, m in zip(start[i].tolist(), n_ends[i].tolist(), strict=True)]
            cut = start[i]
            top_key = (h1[cut, d - 1], h2[cut, d - 1])
            yield _batch({
                "kind": "node", "part": part, "depth": segment * level[i] + d, "s1": one["p1"][cut], "s2": one["p2"][cut], "u1": top_key[0], "u2": top_key[1],
                "conv": least[i], "parent": pa.array(parent[1][above[i]], mask=pending), "n_convs": (stop - start)[i], "n_children": children[i],
                "n_leaves": kids[i], "saved_tokens": last_leaf[i], "ends": sha,
            }, len(i))
        if partial.any():
            i = np.flatnonzero(partial)
            cut = start[i]
            q1, q2, p1, p2 = h1[cut, d], h2[cut, d], one["p1"][cut], one["p2"][cut]
            if d == segment:
                q1, q2, p1, p2 = np.zeros_like(q1), np.zeros_like(q1), one["n1"][cut], one["n2"][cut]
            only_children = top[i]
            depth = segment * level[i] + d
            zero = np.where(only_children, 0, 1)
            # Only the last node of a segment may have a parent that is whole in this shard.
            settled = pa.array(parent[1][above[i]], mask=parent[2][above[i]]) if d else None
            u1, u2 = (h1[cut, d - 1], h2[cut, d - 1]) if d else (q1, q2)
            yield _batch({
                "kind": "part", "part": part, "depth": depth, "p1": p1, "p2": p2, "q1": q1, "q2": q2, "u1": u1, "u2": u2,
                "conv": pa.array(least[i], mask=only_children), "n_convs": (stop - start)[i] * zero, "n_children": children[i],
                "n_leaves": kids[i] * zero, "saved_tokens": last_leaf[i] * zero, "first": first[i], "last": last[i],
                "local": d, "parent": settled, "s1": one["p1"][cut], "s2": one["p2"][cut],
            }, len(i))
            for j, (a, m) in enumerate(zip(cut.tolist(), n_ends[i].tolist(), strict=True)):
                if m and not only_children[j]:
                    ids = one["conv"][a : a + m].tolist()
                    step = PIECE // 20
                    pieces = [",".join(map(str, ids[x : x + step])) for x in range(0, m, step)]
                    yield _batch({
                        "kind": "ends", "part": part, "depth": int(depth[j]), "p1": int(p1[j]), "p2": int(p2[j]), "q1": int(q1[j]), "q2": int(q2[j]),
                        "ends": pieces, "piece": list(range(len(pieces))),
                    }, len(pieces))
        # For the next depth: starts, smallest members, is the smallest member known only after recombining?
        parent = (start, least, partial | top)


EDGE = "part int, side string, level long, p1 long, p2 long, a array<long>, b array<long>, words array<long>, more boolean, conv long"


def _edges(s: Shard, part: int) -> pa.RecordBatch:
    rows = [0, s.n - 1]
    take = lambda m: [m[i, : s.length[i]].tolist() for i in rows]
    one = {c: s.one[c][rows] for c in ("level", "p1", "p2", "more", "conv")}
    return pa.RecordBatch.from_arrays(
        [pa.array([part, part], pa.int32()), pa.array(["first", "last"]), *[pa.array(one[c]) for c in ("level", "p1", "p2")],
         *[pa.array(take(m), pa.list_(pa.int64())) for m in (s.a, s.b, s.words)], pa.array(one["more"]), pa.array(one["conv"])],
        ["part", "side", "level", "p1", "p2", "a", "b", "words", "more", "conv"],
    )


def _sharded(rows: DataFrame) -> DataFrame:
    n = rows.count()
    width = max(shuffle_width(rows.sparkSession), -(-n // SHARD))
    return rows.repartitionByRange(width, "level", "p1", "p2", F.arrays_zip("a", "b"), "more", "conv")


def _over_shards(rows: DataFrame, work, schema: str) -> DataFrame:
    """``work(shard, part)`` of every range partition; all of a partition's rows are one shard."""

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if held:
            yield from work(Shard(pa.Table.from_batches(held)), TaskContext.get().partitionId())

    return in_arrow(_sharded(rows), run, schema)


def _agreement(edges: DataFrame) -> DataFrame:
    """(part, same, words_before, last_part, ...): depth up to which a shard's first row is that of the shard before, -1: nothing. A row a shard."""
    first, last = (edges.where(F.col("side") == side).drop("side") for side in ("first", "last"))
    both = first.join(last.select(*[F.col(c).alias(c if c == "part" else f"l_{c}") for c in last.columns]), "part")
    order = Window.orderBy("part")
    both = both.select("*", *[F.lag(f"l_{c}").over(order).alias(f"o_{c}") for c in ("level", "p1", "p2", "a", "b", "more", "conv")], F.lag("part").over(order).alias("o_part"))
    top = (F.col("level") == F.col("o_level")) & (F.col("p1") == F.col("o_p1")) & (F.col("p2") == F.col("o_p2"))
    equal = F.transform(
        F.sequence(F.lit(0), F.least(F.size("a"), F.size("o_a"))),
        lambda d: (F.slice("a", F.lit(1), d) == F.slice("o_a", F.lit(1), d)) & (F.slice("b", F.lit(1), d) == F.slice("o_b", F.lit(1), d)),
    )
    same = F.when(F.col("o_part").isNull() | ~top, F.lit(-1)).otherwise(F.size(F.filter(equal, lambda x: x)) - 1)
    out = both.withColumn("same", same)
    # The last row of the shard before is no leaf if this shard's first row goes on from it or equals it.
    return out.withColumn("no_leaf", (F.col("same") == F.size("o_a")) & ~F.col("o_more"))


def _prefix_words(upto: Column) -> Column:
    """Words of the first ``upto`` turns of ``words``."""
    return F.aggregate(F.slice("words", F.lit(1), F.greatest(upto, F.lit(0))), F.lit(0).cast("long"), lambda s, x: s + x)


def _carried(rows: DataFrame) -> DataFrame:
    """``rows`` with carry_saved and carry_leaves: what a conversation's later segments add to the nodes above them."""
    own = "kind string, conv long, level long, saved long, leaf long"
    deeper = rows.where("level > 0").select("*", F.lit(0).cast("long").alias("carry_saved"), F.lit(0).cast("long").alias("carry_leaves"))

    def work(s: Shard, part: int):
        sums = s.again.sum(1)
        base = pa.Table.from_arrays([pa.array(["own"] * s.n), pa.array(s.one["conv"]), pa.array(s.one["level"]), pa.array(sums), pa.array(s.leaf.astype(np.int64))], ["kind", "conv", "level", "saved", "leaf"])
        edge = pa.Table.from_batches([_edges(s, part)]).rename_columns([f"e_{c}" for c in ("part", "side", "level", "p1", "p2", "a", "b", "words", "more", "conv")])
        for t in (base, edge):
            names = [*base.column_names, *edge.column_names]
            filled = [t[c] if c in t.column_names else pa.nulls(t.num_rows, (base if c in base.column_names else edge)[c].type) for c in names]
            yield from pa.Table.from_arrays(filled, names).combine_chunks().to_batches()

    schema = own + ", " + ", ".join(f"e_{x}" for x in EDGE.split(", "))
    found = stored(_over_shards(deeper, work, schema), "trie-deeper")
    edges = found.where("e_part is not null").select(*[F.col(f"e_{x.split()[0]}").alias(x.split()[0]) for x in EDGE.split(", ")])
    near = _agreement(edges)
    mine = found.where("kind = 'own'").select("conv", "level", "saved", "leaf")
    twice = near.where("same >= 0").select("conv", "level", _prefix_words(F.col("same")).alias("saved"), F.lit(0).cast("long").alias("leaf"))
    off = near.where("no_leaf").select(F.col("o_conv").alias("conv"), F.col("o_level").alias("level"), F.lit(0).cast("long").alias("saved"), F.lit(-1).cast("long").alias("leaf"))
    mine = mine.unionByName(twice).unionByName(off).groupBy("conv", "level").agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    # The first segments have nothing of their own here, but take the sums of all later ones.
    tops = rows.where("level = 0 and more").select("conv", "level", F.lit(0).cast("long").alias("saved"), F.lit(0).cast("long").alias("leaf"))
    rest = _running(mine.unionByName(tops), {"saved": F.sum("saved"), "leaf": F.sum("leaf")}, later=True)
    rest = rest.select("conv", "level", F.col("saved_rest").alias("carry_saved"), F.col("leaf_rest").alias("carry_leaves"))
    going_on = rows.where("more").join(rest, ["conv", "level"])
    done = rows.where("not more").select("*", F.lit(0).cast("long").alias("carry_saved"), F.lit(0).cast("long").alias("carry_leaves"))
    return done.unionByName(going_on)


def _hashed_ends(pieces: DataFrame) -> DataFrame:
    """SHA-256 of each boundary node's member list, read piece by piece in order."""

    def run(batches):
        key, state, out = None, None, []
        for b in batches:
            columns = [b.column(b.schema.get_field_index(c)).to_pylist() for c in (*KEY, "ends")]
            for *own, text in zip(*columns, strict=True):
                if own != key:
                    if key is not None:
                        out.append([*key, state.hexdigest()])
                    key, state = own, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.encode())
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], [*KEY, "sha"])
                out = []
        if key is not None:
            out.append([*key, state.hexdigest()])
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], [*KEY, "sha"])

    spread = pieces.select(*KEY, "part", "piece", "ends").repartition(*KEY).sortWithinPartitions(*KEY, "part", "piece")
    return in_arrow(spread.select(*KEY, "ends"), run, ", ".join(f"{k} long" for k in KEY) + ", sha string")


def prefix_trie(conversations: DataFrame, id_col: str = "conv_id", share: tuple[int, int] | None = None, segment: int = SEGMENT) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node; ``conv_id`` is
    the smallest member. ``share`` rebuilds the conversations first (:func:`_rebuilt`)."""
    turns, convs = _rebuilt(*_numbered(conversations, id_col), share)
    rows = _carried(_segments(turns, convs, segment))

    def work(s: Shard, part: int):
        yield from (_wide(b, None) for b in _nodes(s, part, segment))
        yield _wide(None, _edges(s, part))

    edge_fields = [x.split() for x in EDGE.split(", ")]
    schema = NODE + ", " + ", ".join(f"e_{n} {k}" for n, k in edge_fields)
    found = stored(_over_shards(rows, work, schema), "trie-nodes")
    near = _agreement(found.where("e_part is not null").select(*[F.col(f"e_{n}").alias(n) for n, _ in edge_fields]))
    near = near.select("part", "same", "words", "o_part", "no_leaf")

    sums = [*SUMS, "conv"]
    partial = found.where("kind = 'part'").select("part", *KEY, "u1", "u2", "s1", "s2", *sums, "parent", "first", "last", "local")
    fix = partial.join(near.select("part", "same", "words"), "part", "left")
    on_path = F.col("first") & (F.col("local") <= F.col("same"))
    counted = F.col("n_convs") > 0
    fix = fix.withColumn("n_children", F.col("n_children") - F.when(F.col("first") & (F.col("local") < F.col("same")), 1).otherwise(0))
    # From this depth on, the first row opens no node up to depth ``same``.
    again = _prefix_words(F.col("same")) - _prefix_words(F.col("local") - 1)
    fix = fix.withColumn("saved_tokens", F.col("saved_tokens") + F.when(on_path & counted, again).otherwise(0))
    fix = fix.drop("same", "words").join(near.where("no_leaf").select(F.col("o_part").alias("part"), "no_leaf"), "part", "left")
    fix = fix.withColumn("n_leaves", F.col("n_leaves") - F.when(F.col("last") & F.col("no_leaf") & counted, 1).otherwise(0))
    # A node at a segment's top has its parent from the segment before.
    from_above = F.when(counted, F.struct("s1", "s2", "u1", "u2"))
    joined = fix.groupBy(*KEY).agg(*[F.sum(c).alias(c) for c in SUMS], F.min("conv").alias("conv"), F.min("parent").alias("parent"), F.max(from_above).alias("up"))
    boundary = stored(joined.select(*KEY, *sums, "parent", "up.s1", "up.s2", "up.u1", "up.u2"), "trie-boundary")
    hashed = _hashed_ends(found.where("kind = 'ends'"))
    known = boundary.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("s1"), F.col("p2").alias("s2"), F.col("q1").alias("u1"), F.col("q2").alias("u2"), F.col("conv").alias("up_conv"))
    up = ["depth", "s1", "s2", "u1", "u2"]
    none = hashlib.sha256(b"").hexdigest()
    edge_nodes = boundary.join(hashed, KEY, "left").select(*up, *sums, F.coalesce("sha", F.lit(none)).alias("ends"), "parent")
    inner = found.where("kind = 'node'").select(*up, *sums, "ends", "parent")
    every = inner.unionByName(edge_nodes)
    settled = every.where("parent is not null").drop("s1", "s2", "u1", "u2")
    open_ = every.where("parent is null").drop("parent").join(known, up, "left").withColumnRenamed("up_conv", "parent")
    out = settled.unionByName(open_.select(*settled.columns))
    return out.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), *SUMS, F.col("ends").alias("ends_sha256")
    )


def _wide(node: pa.RecordBatch | None, edge: pa.RecordBatch | None) -> pa.RecordBatch:
    """A row of either kind in the common schema."""
    n = (node or edge).num_rows
    own = [node.column(i) if node is not None else pa.nulls(n, _KIND[k]) for i, (_, k) in enumerate(_NODE)]
    kinds = {"int": pa.int32(), "string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
    fields = [x.split() for x in EDGE.split(", ")]
    ends = [edge.column(i) if edge is not None else pa.nulls(n, kinds[k]) for i, (_, k) in enumerate(fields)]
    return pa.RecordBatch.from_arrays([*own, *ends], [*[x for x, _ in _NODE], *[f"e_{x}" for x, _ in fields]])
