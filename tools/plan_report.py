"""Summarise the final adaptive plan of every batch query (PLANS.md).

    python tools/plan_report.py [sf_dir] > PLANS.md

Each query runs once so the adaptive plan is final, then the
physical plan is scanned for: parquet scans (and their pushed filters and
read columns), shuffle exchanges (reused ones counted apart), join
strategies, aggregate and window operators.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fleetspark.plans import catalog  # noqa: E402
from fleetspark.session import local_session  # noqa: E402


def final_plan(df) -> str:
    # Execute this DataFrame's own query execution (a write would plan a new
    # one), so that explain() prints the final adaptive plan. Dev tool only.
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    txt = buf.getvalue()
    if "== Final Plan ==" in txt:
        txt = txt.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return txt


def summarise(txt: str) -> dict:
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)[^\n]*?(Inner|LeftOuter|LeftAnti|LeftSemi|RightOuter|FullOuter)?,", txt)
    scans = re.findall(r"FileScan parquet \[[^\]]*\][^\n]*Location: \w+\(\d+ paths\)\[[^\]]*/([\w.]+)\]", txt)
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", txt)
    return {
        "scans": len(scans),
        "tables": sorted(set(scans)),
        "exchanges": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", txt)),
        "reused": len(re.findall(r"ReusedExchange", txt)),
        "broadcasts": len(re.findall(r"BroadcastExchange", txt)),
        "joins": sorted({f"{a} {b}".strip() for a, b in joins}),
        "aggregates": len(re.findall(r"(HashAggregate|SortAggregate|ObjectHashAggregate)\(", txt)),
        "windows": len(re.findall(r"\bWindow \[", txt)),
        "pushed": sorted({p for p in pushed if p}),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, shuffle_partitions=8)
    print(f"# PLANS\n\nFinal adaptive plans of the registered batch queries at `{sf_dir}` "
          "(generated by `tools/plan_report.py`). Exchanges count shuffles of any size, including AQE-broadcast "
          "summaries; *reused* exchanges are shuffles computed once and read again.\n")
    print("| query | scans (tables) | exchanges | reused | broadcasts | joins | aggs | windows | pushed filters |")
    print("|---|---|---|---|---|---|---|---|---|")
    for name, fn in catalog.BATCH_QUERIES.items():
        s = summarise(final_plan(fn(spark, sf_dir)))
        print(f"| {name} | {s['scans']} ({', '.join(t.replace('.parquet', '') for t in s['tables'])}) | {s['exchanges']} | "
              f"{s['reused']} | {s['broadcasts']} | {'; '.join(s['joins']) or '-'} | {s['aggregates']} | {s['windows']} | "
              f"{'; '.join(s['pushed'])[:120] or '-'} |")
    spark.stop()


if __name__ == "__main__":
    main()
