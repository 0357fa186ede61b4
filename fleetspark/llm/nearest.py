"""Nearest neighbours by inner product: inverted lists with an adaptive scan of the dimensions (op13).

Largest inner product is turned into smallest distance: a vector x gets one more column sqrt(M^2 - |x|^2), M the
largest norm, a query gets a zero there. All columns are then rotated by one random orthogonal matrix, so that any
block of columns is a fair sample of the whole distance. Within each probed list the scan adds up block after block
of columns; after each, a hypothesis test (is the distance seen so far, scaled to all columns, beyond the best known
bound by more than the sampling error?) abandons candidates. What survives all blocks is scored in double precision on the
original vectors.

At scale: equal vectors are one class with the smallest ``k + 1`` ids (more can't be among a query's ``k``), limited
before the shuffle, so a vector that a third of all rows share is scored once. The lists' centroids, the rotation
and the number of lists to probe come from a sample of about ``SAMPLE`` classes chosen by hash (a documented bound;
every row is indexed). Lists are put into bins of about ``BIN_ROWS`` classes, a larger list is split over
several bins; the queries of a bin go in lots of ``LOT`` to their own tasks. A query is sent once to a bin with the
numbers of its probed lists. Every group is bounded by ``BIN_ROWS`` + ``LOT`` rows, whatever the table's size.

The result is approximate: ``probes`` is the number of lists that finds ``RECALL`` of the neighbours of sampled queries within the
sample, and the tests err with a small chance set by ``EPSILON``; tests measure recall against brute force.

Defined cases: vectors that are NULL, empty, zero or hold NULL, NaN or infinite components take no part, nor do rows
without an id and vectors of another length than the most common one (of equally common ones the shortest); rows that
repeat id and vector count once; a query finds all others if there are fewer than ``k``; ties go to the smaller id; an empty
table gives an empty result; only the id and the vector are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import clean_columns, in_arrow, ship, shuffle_width, stored

#: Classes that the index is fitted on, about, and their bytes at most.
SAMPLE = 16_384
SAMPLE_BYTES = 64 << 20
MAX_LISTS = 4096
BIN_ROWS = 8192
LOT = 1024
BLOCK = 16
EPSILON = 2.1
RECALL = 0.98
ROUNDS = 8
#: Query and candidate pairs looked at together inside a task.
PAIRS = 1 << 19


def vectors_of(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, dim)


@dataclass
class Index:
    """What the sample gives: rotation, centroids (rotated, one column more) and the number of lists to probe."""

    norm: float
    rotation: np.ndarray
    centroids: np.ndarray
    probes: int
    k: int

    def turned(self, x: np.ndarray, query: bool) -> np.ndarray:
        rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.norm**2 - (x * x).sum(1), 0))
        return (np.column_stack([x, rest]) @ self.rotation).astype(np.float32)

    def far(self, turned: np.ndarray) -> np.ndarray:
        """Squared distances to the centroids less a constant of each row."""
        return (self.centroids * self.centroids).sum(1) - 2 * turned @ self.centroids.T


def fit(sample: np.ndarray, norm: float, classes: int, k: int, seed: int = 7) -> Index:
    rng = np.random.default_rng(seed)
    dim = sample.shape[1] + 1
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    lists = int(min(MAX_LISTS, max(1, round(classes**0.5)), len(sample)))
    index = Index(norm, rotation, np.zeros((lists, dim), np.float32), lists, k)
    points = index.turned(sample, query=False)
    index.centroids = points[rng.choice(len(points), lists, replace=False)].copy()
    for _ in range(ROUNDS):
        own = np.concatenate([index.far(points[i : i + 4096]).argmin(1) for i in range(0, len(points), 4096)])
        order = np.argsort(own, kind="stable")
        found, start = np.unique(own[order], return_index=True)
        sums = np.add.reduceat(points[order].astype(np.float64), start, axis=0)
        index.centroids[found] = (sums / np.diff(np.append(start, len(order)))[:, None]).astype(np.float32)
    # Lists to probe: so many that RECALL of the sampled queries' neighbours within the sample lie in them.
    own = np.concatenate([index.far(points[i : i + 4096]).argmin(1) for i in range(0, len(points), 4096)])
    asked = sample[rng.choice(len(sample), min(256, len(sample)), replace=False)]
    near = min(k + 1, len(sample))
    best = np.argpartition(-(asked @ sample.T), near - 1, axis=1)[:, :near]
    rank = np.argsort(np.argsort(index.far(index.turned(asked, query=True)), axis=1), axis=1)
    needed = np.sort(np.take_along_axis(rank, own[best], axis=1).ravel())
    index.probes = int(needed[min(len(needed) - 1, int(RECALL * len(needed)))]) + 1
    return index


def scan(queries: np.ndarray, bound: np.ndarray, turned: np.ndarray, turned_queries: np.ndarray, vectors: np.ndarray, norm: float, epsilon: float = EPSILON) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of the pairs within one list that no test abandons and that reach the query's bound."""
    dim = turned.shape[1]
    # Distance that belongs to the bound; slack for 32-bit sums.
    limit = np.maximum((queries * queries).sum(1) + norm**2 - 2 * bound, 0) + 1e-4 * (norm**2 + 1e-30)
    limit = np.where(np.isfinite(bound), limit, np.inf)
    found = []
    step = max(1, PAIRS // max(len(vectors), 1))
    for a in range(0, len(queries), step):
        q = turned_queries[a : a + step]
        x, y = turned[:, :BLOCK], q[:, :BLOCK]
        seen = (y * y).sum(1)[:, None] + (x * x).sum(1)[None] - 2 * y @ x.T
        at, top = min(BLOCK, dim), limit[a : a + step]

        def allowed(i: np.ndarray | slice) -> np.ndarray:
            return top[i] * (1 + (epsilon / at**0.5 if at < dim else 0)) ** 2 * at / dim  # noqa: B023

        qi, ci = np.nonzero(seen <= allowed(slice(None))[:, None])
        part = seen[qi, ci]
        while at < dim:
            gap = turned[ci, at : at + BLOCK] - q[qi, at : at + BLOCK]
            part = part + np.einsum("ij,ij->i", gap, gap)
            at = min(at + BLOCK, dim)
            keep = part <= allowed(qi)
            qi, ci, part = qi[keep], ci[keep], part[keep]
        score = (queries[a + qi] * vectors[ci]).sum(1)
        keep = score >= bound[a + qi]
        found.append((a + qi[keep], ci[keep], score[keep]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def best_of(query: np.ndarray, score: np.ndarray, ident: np.ndarray, k: int) -> np.ndarray:
    """Positions of each query's ``k`` best, ties to the smaller ident."""
    order = np.lexsort((ident, -score, query))
    sorted_query = query[order]
    first = np.searchsorted(sorted_query, sorted_query)
    return order[np.arange(len(order)) - first < k]


def scan_bin(index: Index, classes: pa.Table, asked: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All probed lists of a bin for all queries of a lot: (query row, class row, score), the best ``k + 1`` of each query."""
    dim = index.rotation.shape[0] - 1
    vectors, queries = (vectors_of(t["vec"].combine_chunks(), dim) for t in (classes, asked))
    rep, place = classes["rep"].to_numpy(), classes["list"].to_numpy()
    turned, turned_queries = index.turned(vectors, False), index.turned(queries, True)
    bound = np.full(len(queries), -np.inf)
    counts = asked["lists"].combine_chunks().value_lengths().to_numpy()
    flat = asked["lists"].combine_chunks().flatten().to_numpy()
    who = np.repeat(np.arange(len(queries)), counts)
    nearest_first = np.zeros(len(flat), bool)
    nearest_first[np.cumsum(counts) - counts] = True
    best = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
    order = np.argsort(place, kind="stable")
    sorted_place = place[order]
    # Each query's nearest list comes first and, as there is no bound yet, whole: what it finds is the bound of the rest.
    for start in (True, False):
        for one in np.unique(flat[nearest_first == start]):
            rows = order[np.searchsorted(sorted_place, one) : np.searchsorted(sorted_place, one, "right")]
            mine = who[(flat == one) & (nearest_first == start)]
            if not len(rows):
                continue
            qi, ci, score = scan(queries[mine], bound[mine], turned[rows], turned_queries[mine], vectors[rows], index.norm)
            best = tuple(np.concatenate(x) for x in zip(best, (mine[qi], rows[ci], score), strict=True))
            kept = best_of(best[0], best[2], rep[best[1]], index.k + 1)
            best = tuple(x[kept] for x in best)
            worst = np.full(len(queries), np.inf)
            np.minimum.at(worst, best[0], best[2])
            full = np.bincount(best[0], minlength=len(queries)) > index.k
            bound[full] = worst[full]
    return best


def _classes(vectors: DataFrame, id_col: str, vector_col: str, k: int) -> DataFrame:
    """Distinct vectors (h1, h2) with their smallest ids; what takes no part is left out."""
    rows = clean_columns(vectors, id_col, vector_col).toDF("id", "vec").select(F.col("id").cast("long").alias("id"), F.col("vec").cast("array<double>").alias("vec"))
    usable = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("vec", lambda x: x != 0)
    rows = rows.where(F.col("id").isNotNull() & F.col("vec").isNotNull() & usable)
    return rows.select("id", "vec", F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(1), "vec").alias("h2"))


def nearest(vectors: DataFrame, is_query: str = "true", id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20) -> DataFrame:
    """(query_id, rank from 1, id, score) of the ``k`` nearest of every row that is a query; ``is_query`` is an SQL
    condition on the column ``id``."""
    spark = vectors.sparkSession
    out = f"query_id long, rank int, {id_col} long, score double"
    keyed = _classes(vectors, id_col, vector_col, k)
    lengths = keyed.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], out)
    dim = lengths[0]["n"]
    keyed = keyed.where(F.size("vec") == dim)
    ids = keyed.select("h1", "h2", "id").distinct()
    in_class = Window.partitionBy("h1", "h2").orderBy("id")
    first = ids.withColumn("n", F.row_number().over(in_class)).where(F.col("n") <= k + 1)
    members = first.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.sort_array(F.collect_list("id")).alias("ids"))
    one = keyed.groupBy("h1", "h2").agg(F.any_value("vec").alias("vec"))  # equal in all rows of a class
    classes = stored(one.join(members, ["h1", "h2"]).select("h1", "h2", "rep", "ids", "vec"), "nearest-classes")

    size = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)).alias("m")).first()
    wanted_rows = min(SAMPLE, SAMPLE_BYTES // (8 * dim))
    part = classes.where(F.pmod(F.xxhash64(F.lit(2), "h1", "h2"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, wanted_rows / size["n"])))
    sample = part.select("rep", "vec").toArrow().sort_by("rep")
    if not sample.num_rows:  # by chance, of a very small table
        sample = classes.orderBy("rep").limit(1).select("rep", "vec").toArrow()
    index = fit(vectors_of(sample["vec"].combine_chunks(), dim), float(size["m"]) ** 0.5, size["n"], k)
    shared = spark.sparkContext.broadcast(index)

    def place(batches):
        for b in batches:
            if b.num_rows:
                x = shared.value.turned(vectors_of(b.column("vec"), dim), False)
                yield b.append_column("list", pa.array(shared.value.far(x).argmin(1).astype(np.int32)))

    listed = stored(in_arrow(classes, place, "h1 long, h2 long, rep long, ids array<long>, vec array<double>, list int"), "nearest-lists")
    counts = {r["list"]: r["count"] for r in listed.groupBy("list").count().collect()}  # at most MAX_LISTS rows
    bin_rows = max(256, min(BIN_ROWS, size["n"] // shuffle_width(spark)))  # no fewer bins than tasks
    first_bin, parts, filled, number = {}, {}, 0, -1
    for one_list in sorted(counts):
        parts[one_list] = -(-counts[one_list] // bin_rows)
        if number < 0 or filled + counts[one_list] > bin_rows:
            number, filled = number + 1, 0
        first_bin[one_list] = number
        filled += counts[one_list]
        if parts[one_list] > 1:
            number, filled = number + parts[one_list] - 1, bin_rows
    held = np.zeros(len(index.centroids), np.int64)
    held[list(counts)] = list(counts.values())
    table = spark.createDataFrame([(a, first_bin[a], parts[a]) for a in counts], "list int, first_bin int, parts int")

    own_queries = ids.where(is_query)
    asking = classes.join(own_queries.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi").select("rep", "vec")

    def probe(batches):
        ix = shared.value
        for b in batches:
            for a in range(0, b.num_rows, 512):
                part = b.slice(a, 512)
                x = vectors_of(part.column("vec"), dim)
                far = ix.far(ix.turned(x, True))
                lists = np.argsort(far, axis=1, kind="stable").astype(np.int32)
                # As many lists as the sample asks for, and more where they don't hold k + 1 classes.
                n = np.maximum(ix.probes, 1 + (np.cumsum(held[lists], axis=1) < ix.k + 1).sum(1))
                bins: dict[tuple[int, int], list[int]] = {}
                for i, row in enumerate(lists):
                    for one in row[: n[i]].tolist():
                        if one in first_bin:
                            for p in range(parts[one]):
                                bins.setdefault((i, first_bin[one] + p), []).append(one)
                at = np.array([i for i, _ in bins], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("rep").take(pa.array(at)), part.column("vec").take(pa.array(at)),
                     pa.array([b for _, b in bins], pa.int32()), pa.array(list(bins.values()), pa.list_(pa.int32()))],
                    ["rep", "vec", "bin", "lists"],
                )

    asked = stored(in_arrow(asking, probe, "rep long, vec array<double>, bin int, lists array<int>"), "nearest-asked")
    lots = asked.groupBy("bin").agg(F.ceil(F.count(F.lit(1)) / LOT).cast("int").alias("lots"))
    asked = asked.join(lots, "bin").select("rep", "vec", "bin", "lists", F.pmod(F.xxhash64("rep"), "lots").cast("int").alias("lot"))
    dealt = listed.join(F.broadcast(table), "list").select("rep", "vec", "list", (F.col("first_bin") + F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")).alias("bin"))
    dealt = dealt.join(lots, "bin").select("rep", "vec", "list", "bin", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)).alias("lot"))

    def scan_group(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            q = c = np.empty(0, np.int64)
            score = np.empty(0)
        else:
            q, c, score = scan_bin(shared.value, left, right)
        return pa.table({"query": right["rep"].take(pa.array(q)), "rep": left["rep"].take(pa.array(c)), "score": pa.array(score)})

    ship(spark)
    pairs = dealt.groupBy("bin", "lot").cogroup(asked.groupBy("bin", "lot")).applyInArrow(scan_group, "query long, rep long, score double")
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    pairs = pairs.withColumn("n", F.row_number().over(by_score)).where(F.col("n") <= k + 1)
    single = pairs.join(classes.select("rep", "ids"), "rep").select("query", "score", F.explode("ids").alias("id"))
    near = single.groupBy("query").agg(F.collect_list(F.struct((-F.col("score")).alias("s"), "id")).alias("near"))
    near = near.select("query", F.slice(F.sort_array("near"), 1, k + 1).alias("near"))
    queries = own_queries.join(classes.select("h1", "h2", F.col("rep").alias("query")), ["h1", "h2"]).select(F.col("id").alias("query_id"), "query")
    own = F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, k)
    ranked = queries.join(near, "query").select("query_id", F.posexplode(own).alias("p", "x"))
    return ranked.select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.id").alias(id_col), (-F.col("x.s")).alias("score"))
