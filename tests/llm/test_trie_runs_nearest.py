"""op11, op12 and op13 against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from fleetspark.llm import queries
from fleetspark.llm.nearest import EPSILON, fit, nearest, scan
from fleetspark.llm.periodic_runs import find_runs, periodic_runs
from fleetspark.llm.prefix_trie import prefix_trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- op11 ----------------------------------------------------------------------------------------------------------
def trie_of(rows, share):
    by = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            by[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in by.items()}
    built = {}
    for c, v in own.items():
        base, h = (c - c % share[0], zlib.crc32(str(c).encode()) % share[1]) if share else (c, 0)
        built[c] = v if base == c else own.get(base, [])[:h] + v[h:]
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for n in members:
        if n:
            kids[n[:-1]] += 1
    for n, m in members.items():
        for d in range(len(n) + 1):
            saved[n[:d]] += (len(m) - 1) * len(WORD.findall(n[-1][1])) if n else 0
            leaves[n[:d]] += not kids[n]
    ends = {n: ",".join(str(c) for c in m if len(built[c]) == len(n)) for n, m in members.items()}
    out = [(m[0], len(n), members[n[:-1]][0] if n else None, len(m), kids[n], leaves[n], saved[n], sha(ends[n])) for n, m in members.items()]
    return sorted(out, key=repr)


def trie(spark, rows, share=(20, 4), **more):
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, depth string")
    return sorted((tuple(r) for r in prefix_trie(df, share=share, **more).collect()), key=repr)


@pytest.mark.parametrize("seed, segment", [(1, 32), (2, 3), (3, 2)])
def test_trie_matches_brute_force(spark, seed, segment):
    """NULL turns, roles and texts, ties, absent bases, conversations left without turns; sequences cut into segments."""
    rng = random.Random(seed)
    rows = [(None, 1, "user", "no conversation")]
    for c in rng.sample(range(400), 120):
        for i in range(rng.randint(1, 9)):
            text = rng.choice(["a b", "a", None, "c  d e", ""]) if i < 3 else rng.choice(["x y", "z"])
            rows.append((c, None if rng.random() < 0.1 else i, rng.choice(["user", "assistant", None]), text))
    assert trie(spark, rows, segment=segment) == trie_of(rows, (20, 4))


def test_trie_of_copies_and_of_one_long_conversation(spark):
    """Copies of one conversation over all shards, and one conversation with a third of all rows."""
    rows = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(4)]
    rows += [(1001, t, "user", f"turn {t}" if t < 4 else f"long {t % 7}") for t in range(600)]
    rows += [(1002, t, "user", f"turn {t}" if t < 4 else f"long {t % 7}") for t in range(300)]
    assert trie(spark, rows, share=None, segment=8) == trie_of(rows, None)


def test_trie_of_little(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 1, "a", "b")]) == []
    rows = [(5, 1, "user", "one two"), (5, 1, "user", "one two"), (7, None, None, None)]
    assert trie(spark, rows) == trie_of(rows, (20, 4))
    assert trie(spark, rows, share=None) == trie_of(rows, None)


# --- op12 ----------------------------------------------------------------------------------------------------------
def runs_of(w, least=24):
    n, out = len(w), {}
    for p in range(1, n // 3 + 1):
        i = 0
        while i < n - p:
            j = i
            while j < n - p and w[j] == w[j + p]:
                j += 1
            if j > i and j - i + p >= max(least, 3 * p):
                out.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted((s, length, p) for (s, length), p in out.items())


def periodic_row(ident, text):
    w = WORD.findall(text or "")
    n = len(w)
    h = zlib.crc32(str(ident).encode()) if ident is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = runs_of(w)
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    figures = (*best, 1000 * best[1] // best[2] if runs else None)
    return (ident, len(runs), *figures, sha("".join(f"{s},{length},{p}\n" for s, length, p in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def made_periodic(rng, n, kinds):
    w = [str(rng.randrange(kinds)) for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        a = rng.randrange(n)
        p = rng.randint(1, max(1, (n - a) // 3))
        for i in range(a, a + rng.randint(0, n - a)):
            w[i] = w[a + (i - a) % p]
    return w


def test_runs_match_brute_force():
    rng = random.Random(4)
    for _ in range(150):
        docs = [made_periodic(rng, rng.randint(1, 150), rng.choice([1, 2, 3, 50])) for _ in range(rng.randint(1, 5))]
        values = np.array([zlib.crc32(x.encode()) * 0x9E3779B1 for w in docs for x in w], np.uint64)
        found = find_runs(values, np.cumsum([0, *map(len, docs)]))
        for d, w in enumerate(docs):
            assert [tuple(r[1:]) for r in found.tolist() if r[0] == d] == runs_of(w)


def test_words_without_cubes_have_no_runs():
    """The Thue-Morse words, whose blocks collide under sums modulo a power of two."""
    values = np.array([bin(i).count("1") & 1 for i in range(1 << 13)], np.uint64) * np.uint64(12345677) + np.uint64(11)
    assert len(find_runs(values, np.array([0, len(values)]))) == 0


def test_periodic_texts_match_brute_force(spark):
    """Planted periods, runs of the text's own, mixed white space, many bytes a character, repeated rows, NULLs, a long text."""
    rng = random.Random(5)
    rows = [(i, rng.choice([" ", "\n", "  ", "  "]).join(made_periodic(rng, rng.randint(1, 200), rng.choice([2, 40])))) for i in range(150)]
    rows += [(900, None), (901, ""), (902, " \t\n"), (903, "é " * 60), (None, "a b " * 30), (None, None), (904, " ".join(f"w{i % 1700}" for i in range(9000))), rows[3], rows[3]]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_runs int")
    found = periodic_runs(df, planted=True)
    got = found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == sorted((periodic_row(*r) for r in rows), key=repr)
    whole = found.where("doc_id = 903").first()
    assert list(whole.runs) == [0, 60, 1] and whole.collapsed == "é"
    assert periodic_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(df, min_length=10)


# --- op13 ----------------------------------------------------------------------------------------------------------
def nearest_of(rows, is_query, k):
    usable = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    ids = np.array([i for i, _ in usable])
    x = np.array([v for _, v in usable], np.float64)
    out = {}
    for i, v in usable:
        if is_query(i):
            score = (x * np.array(v)).sum(1)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def recall(found, wanted):
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in wanted[q]}) for q in wanted)
    return hits / sum(map(len, wanted.values()))


def found_by(df, **more):
    out = defaultdict(list)
    for r in sorted(nearest(df, "id % 20 = 0", **more).collect()):
        assert r["rank"] == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_supplied_vectors(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/embeddings.parquet")
    wanted = nearest_of([(r.vec_id, r.embedding) for r in df.collect()], lambda i: i % 20 == 0, 20)
    got = queries.op13_nearest(spark, sf_small).collect()
    found = defaultdict(list)
    for r in sorted(got):
        found[r.query_id].append((r.vec_id, r.score))
    assert {q: len(x) for q, x in found.items()} == {q: len(x) for q, x in wanted.items()}
    assert recall(found, wanted) >= 0.9
    for q, near in found.items():
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))
        exact = dict(nearest_of([(r.vec_id, r.embedding) for r in df.collect()], lambda i: i == q, 10**9)[q]) if q == 0 else {}
        assert all(abs(exact[i] - s) < 1e-12 for i, s in near if exact)


def test_copies_norms_and_bad_vectors(spark):
    """A vector that a third of the rows share, norms over three decades, ties, repeated rows, vectors that take no part."""
    rng = np.random.default_rng(6)
    rows = [(i, (rng.standard_normal(12) * 10 ** rng.uniform(-1.5, 1.5)).tolist()) for i in range(900)]
    rows += [(1000 + i, [1.0] * 12) for i in range(450)]
    rows += [rows[0], rows[20], (2000, None), (2020, []), (2040, [0.0] * 12), (2060, [float("nan")] * 12), (2080, [None] * 12), (2100, [float("inf")] * 12),
             (2120, [1.0] * 5), (None, [1.0] * 12)]
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "vec_id long, embedding array<double>, score double")
    wanted = nearest_of([r for r in rows if r[1] is None or len(r[1]) != 5], lambda i: i % 20 == 0, 20)
    found = found_by(df)
    assert set(found) == set(wanted) and all(len(x) == 20 for x in found.values())
    assert recall(found, wanted) >= 0.9
    assert sorted(found[1000])[:1] != [] and 1000 not in {i for i, _ in found[1000]}
    # Copies have one score each, the smaller ids come first.
    copies = [i for i, s in found[1020] if s == 12.0]
    assert copies == sorted(copies)


def test_few_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert nearest(spark.createDataFrame([], schema), "id % 20 = 0").count() == 0
    assert nearest(spark.createDataFrame([(0, [1.0, 2.0])], schema), "id % 20 = 0").count() == 0
    few = [(0, [1.0, 0.0]), (3, [0.5, 1.0]), (7, [0.5, -1.0]), (20, [-1.0, 0.0])]
    found = found_by(spark.createDataFrame(few, schema))
    assert found == {0: [(3, 0.5), (7, 0.5), (20, -1.0)], 20: [(3, -0.5), (7, -0.5), (0, -1.0)]}


def test_the_scan_abandons_most_candidates():
    """With a bound, few pairs get to the last block; without the tests all would be scored."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((4000, 64))
    index = fit(x[:1000], float(np.linalg.norm(x, axis=1).max()), 4000, 20)
    q = x[:50]
    exact = q @ x.T
    bound = np.sort(exact, axis=1)[:, -21]
    qi, ci, score = scan(q, bound, index.turned(x, False), index.turned(q, True), x, index.norm, EPSILON)
    assert np.allclose(score, exact[qi, ci]) and (score >= bound[qi]).all()
    assert len(qi) >= 0.9 * 50 * 21
