"""Mixed buckets of near-dedup: a large family with unlinked outliers, and many unlinked alike texts, in small blocks."""

import random

import pytest

from fleetspark.llm import near_dedup

from .test_small import brute_components, docs


def changed(words, rng, n):
    words = list(words)
    for k in rng.sample(range(len(words)), n):
        words[k] = f"new{rng.randrange(10**9)}"
    return " ".join(words)


def family_rows(seed):
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(120)]
    rows = [(i, changed(base, rng, 1), "a") for i in range(150)]  # linked: one word of 120 is new
    rows += [(1000 + i, changed(base, rng, 18), "a") for i in range(25)]  # similarity about 0.6 to all of them
    rows += [(2000 + i, changed(base, rng, 7), "a") for i in range(25)]  # near the threshold
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [4, 64])
def test_family_with_outliers(spark, block):
    rows = family_rows(7)
    got = near_dedup.near_duplicates(docs(spark, rows), 2, bucket=block).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute_components(rows, 2, 80))


def test_every_pair_across_components_meets_once(spark):
    """Cells of one bucket: 30 rows of one component, 9 of others; each pair across components in exactly one cell."""
    members = [(1, 0, k, 0 if k < 30 else k, 40) for k in range(39)]
    cells = near_dedup.block_cells(spark.createDataFrame(members, "bucket long, hub long, node long, root long, size long"), 4).collect()
    by_cell, met = {}, []
    for r in cells:
        by_cell.setdefault(r.cell, []).append(r)
    for group in by_cell.values():
        for p in group:
            for q in group:
                if p.asks and q.answers and p.root != q.root and (not q.rest or p.node < q.node):
                    met.append((min(p.node, q.node), max(p.node, q.node)))
    wanted = sorted((a, b) for a in range(39) for b in range(max(a + 1, 30), 39))
    assert sorted(met) == wanted
    assert max(map(len, by_cell.values())) <= 30  # blocks go by a hash, of about 4 rows each
