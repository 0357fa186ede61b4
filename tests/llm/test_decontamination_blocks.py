"""The same results whatever the number of benchmark blocks."""

import random

import pytest

from fleetspark.llm import decontamination
from tests.llm.test_small import docs


def _tables(spark):
    rng = random.Random(21)
    vocabulary = [f"v{i}" for i in range(300)]
    long = " ".join(rng.choice(vocabulary) for _ in range(900))  # one item larger than a block
    dashed = "-".join(rng.choice(vocabulary) for _ in range(200))  # one word by blanks, many by the rule
    shared = " ".join(rng.choice(vocabulary) for _ in range(13))
    items = [(1, long), (2, dashed), *[(10 + i, f"{shared} tail{i}") for i in range(40)], (90, "short one"), (91, None), (None, "nobody asks this")]
    pieces = [long.split()[a : a + 30] for a in range(0, 870, 29)] + [dashed.split("-")[5:25], shared.split(), ["short", "one"], ["nobody", "asks", "this"]]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(5, 60))) + " " + " ".join(rng.choice(pieces)).upper(), "a") for i in range(60)]
    rows += [rows[0], rows[0], (None, rows[1][1], "a"), (200, None, "a"), (201, "", "a")]
    return docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("blocks", [3, 50])
def test_blocks_change_nothing(spark, blocks):
    frame, bench = _tables(spark)
    run = lambda size: sorted(map(tuple, decontamination.contamination(frame, bench, spans=True, block_windows=size).collect()), key=repr)
    windows = decontamination.benchmark_windows(bench, decontamination.WINDOW, "item_id", "text").count()
    assert windows > 1000
    whole = run(10_000)
    assert sum(r[2] > 0 for r in whole) > 50 and max(r[3] for r in whole) >= 40
    assert run(-(-windows // blocks)) == whole
