"""The pipeline's rows against a plain version of its five stages, over a small table with planted cases."""

import random
import re
import zlib
from collections import Counter

import corpus_pipeline
from fleetspark.llm.packing import CAPACITY

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def passes_rules(text):
    w = WORD.findall(text or "")

    def covered(n):
        seen = Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
        return len({p for i in range(len(w) - n + 1) if seen[tuple(w[i : i + n])] > 1 for p in range(i, i + n)})

    return len(w) >= 50 and 100 * covered(3) <= 50 * len(w) and 100 * covered(10) <= 50 * len(w) and not covered(201)


def first_of_each_group(docs):
    """docs: {id: text}; the smallest id of each component of 5-word sets at 0.8."""
    sets = {}
    for i, t in docs.items():
        w = WORD.findall(t.translate(LOWER))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)}
    root = {i: i for i in docs}
    pairs = [(a, b) for a in docs for b in docs if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            least = min(root[a], root[b])
            changed |= root[a] != root[b]
            root[a] = root[b] = least
    return {i: t for i, t in docs.items() if root[i] == i}


def without_repeats(docs):
    first = {}
    for i in sorted(docs):
        w = WORD.findall(docs[i])
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), i)
    out = {}
    for i, t in docs.items():
        w = WORD.findall(t)
        gone = {p for k in range(len(w) - 49) if first[tuple(w[k : k + 50])] < i for p in range(k, k + 50)}
        if not gone:
            out[i] = t
        elif len(gone) < len(w):
            out[i] = " ".join(x for p, x in enumerate(w) if p not in gone)
    return out


def uncontaminated(docs, items):
    windows = set()
    for t in items:
        w = ALNUM.findall((t or "").translate(LOWER))
        windows |= {tuple(w[k : k + 13]) for k in range(max(1, len(w) - 12))} if w else set()
    lengths = {len(x) for x in windows}
    out = {}
    for i, t in docs.items():
        w = ALNUM.findall(t.translate(LOWER))
        hit = {p for n in lengths for k in range(len(w) - n + 1) if tuple(w[k : k + n]) in windows for p in range(k, k + n)}
        if not (hit and 20 * len(hit) >= len(w)):
            out[i] = t
    return out


def packed(docs, source):
    pieces = []
    for i, t in docs.items():
        n = len(WORD.findall(t))
        for k in range(max(1, -(-n // CAPACITY))):
            pieces.append((-min(CAPACITY, n - k * CAPACITY), i, zlib.crc32(t.encode()), k))
    bins, out = [], []
    for size, i, _, k in sorted(pieces):
        size = -size
        fits = [(b[0], j) for j, b in enumerate(bins) if b[0] >= size and source[i] not in b[1] and docs[i] not in b[2]]
        j = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append([CAPACITY, set(), set()])
        out.append((i, k, k * CAPACITY, size, 0, j, CAPACITY - bins[j][0]))
        bins[j][0] -= size
        bins[j][1].add(source[i])
        bins[j][2].add(docs[i])
    return out


def planted():
    rng = random.Random(31)
    word = lambda: f"w{rng.randrange(4000)}"
    body = lambda n: [word() for _ in range(n)]
    passage, question = body(80), body(20)
    texts = {}
    for i in range(70):
        texts[i] = body(rng.randrange(20, 400))
    for i in range(70, 82):  # near copies of the document before last, and chains of them
        w = list(texts[i - rng.choice([2, 60])])
        w[rng.randrange(len(w))] = "changed"
        texts[i] = w
    for i in range(82, 92):  # a passage that repeats across documents, alone in two of them
        texts[i] = passage if i in (84, 85) else body(60) + passage + body(rng.randrange(5, 90))
    for i in range(92, 100):  # contaminated by a fifth or, below the rule, by less than a twentieth
        texts[i] = body(50) + [x.upper() for x in question] + body(5 if i % 2 else 600)
    texts[100] = body(20) * 8  # repeats itself
    texts[101] = body(2 * CAPACITY + 100)  # three pieces
    texts[102] = list(texts[3])  # an exact copy
    texts[103] = body(60) + ["the", "short", "answer"] + body(10)
    rows = [(i, "\n".join([" ".join(w[:30]), " ".join(w[30:])]), "en", f"s{rng.choice([0, 0, 0, 1, 2, 3])}", 0) for i, w in texts.items()]
    rows += [(200, None, "en", "s1", 0), (201, "", None, None, None), (202, " \n", "en", "s1", 0)]
    return rows, [(1, " ".join(question)), (2, "Short answer!"), (3, None), (4, "absent words of an item that no document holds at all")]


def test_rows_equal_the_plain_stages(spark, tmp_path):
    rows, items = planted()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    source = {i: s for i, _, _, s, _ in rows}
    docs = {i: t for i, t, *_ in rows if passes_rules(t)}
    counts = [len(rows), len(docs)]
    for stage in (first_of_each_group, without_repeats, lambda d: uncontaminated(d, [t for _, t in items])):
        docs = stage(docs)
        counts.append(len(docs))
    assert counts == sorted(set(counts), reverse=True)  # every stage has something to do
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted(packed(docs, source))
