"""Best fit with several packing groups and near copies, against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from fleetspark.llm import packing
from fleetspark.llm.group_links import components
from tests.llm.test_small import brute_pack, docs

WORD = re.compile(r"[^ \t-\r]+")


def linked(texts, n, percent):
    """Smallest position reachable over links of the shingle sets; None without words."""
    sets = []
    for t in texts:
        w = [x.lower() for x in WORD.findall(t or "")]
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    label = list(range(len(texts)))
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            least = min(label[i], label[j])
            changed |= label[i] != label[j]
            label[i] = label[j] = least
    return [x if s else None for x, s in zip(label, sets, strict=True)]


def families(rng, n):
    out = []
    for _ in range(n):
        base = [str(rng.randrange(60)) for _ in range(rng.randint(1, 80))]
        for _ in range(rng.randint(1, 8)):
            w = list(base)
            for _ in range(rng.randint(0, 6)):
                w[rng.randrange(len(w))] = str(rng.randrange(60))
            out.append(" ".join(w))
    return out


@pytest.mark.parametrize("shingle", [2, 5])
def test_components_equal_brute_force(shingle):
    rng = random.Random(11)
    for _ in range(12):
        texts = [*families(rng, 6), None, "", " ", "one", "one"]
        got, want = components(pa.array(texts, pa.string()), shingle, 80).tolist(), linked(texts, shingle, 80)
        first = lambda labels: [None if x in (None, -1) else labels.index(x) for x in labels]
        assert first(got) == first(want)
    assert components(pa.array([], pa.string()), 2, 80).tolist() == []


def test_several_groups_equal_brute_force(spark):
    """Each group's bins are those of plain best fit over its rows, and all rows are in one group each."""
    rng = random.Random(12)
    rows = [(i, t, rng.choice(["a", "b", "c", None])) for i, t in enumerate(families(rng, 60))]
    rows += [(None, "no id", "a"), (2000, None, "b"), (2001, "", "b"), (2002, "", "c"), (2003, None, "c")]
    got = packing.pack(docs(spark, rows), capacity=150, group_rows=60, near=(2, 80)).collect()
    texts = {i: (t, s) for i, t, s in rows}
    assert Counter(r.doc_id for r in got) == Counter(i for i, _, _ in rows)
    groups = defaultdict(dict)
    for r in got:
        groups[r.packing_group][r.doc_id] = r.bin
    assert len(groups) > 3
    for bins in groups.values():
        ids = sorted(bins, key=lambda i: (i is None, i or 0))
        label = dict(zip(ids, linked([texts[i][0] for i in ids], 2, 80), strict=True))
        cluster = {i: ("t", texts[i][0]) if label[i] is None and texts[i][0] is not None else label[i] for i in ids}
        size = {i: len(WORD.findall(texts[i][0] or "")) for i in ids}
        order = sorted(ids, key=lambda i: (-size[i], i is None, i or 0, zlib.crc32((texts[i][0] or "").encode())))
        want = brute_pack([(size[i], ("s", texts[i][1]), cluster[i]) for i in order], 150)
        assert [bins[i] for i in order] == want


def test_rows_repeated_without_bound_are_spread(spark, monkeypatch):
    rows = [(None, "", "a")] * 600 + [(7, "one two", "b")] * 600 + [(None, "one two", f"s{k}") for k in range(300)] + [(8, None, None)] * 40
    want = {(None, 0): 600, (7, 2): 600, (None, 2): 300, (8, 0): 40}
    pack = lambda r, n: packing.pack(docs(spark, r).repartition(n), capacity=150, group_rows=100, lot=8, near=(2, 80)).collect()
    got = pack(rows, 3)
    assert Counter((r.doc_id, r.n_words) for r in got) == want
    assert max(Counter(r.packing_group for r in got).values()) <= 300
    monkeypatch.setattr(packing, "FEW", 0)  # told by a join
    assert Counter(map(tuple, got)) == Counter(map(tuple, pack(rows[::-1], 5)))
    assert packing.pack(docs(spark, []), near=(2, 80)).count() == 0
