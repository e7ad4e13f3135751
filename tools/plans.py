"""Write PLANS.md: per registered query of the portfolio library, the physical-plan facts that matter
at scale (shuffles, join strategies, aggregates, windows, and for each scan
the columns read and the filters pushed into it).  Initial plans, before AQE
re-optimises with measured sizes.

    python tools/plans.py /root/testdata/sf0.1 > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KINDS = ["Exchange", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
         "HashAggregate", "SortAggregate", "ObjectHashAggregate", "Window", "Generate", "Expand"]


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarise(text: str):
    nodes = Counter(re.findall(r"^\(\d+\) (\w+)", text, flags=re.M))
    scans = []
    for block in re.split(r"\n(?=\(\d+\) )", text):
        if not re.match(r"\(\d+\) Scan parquet", block):
            continue
        loc = re.search(r"Location: \w+ \[file:[^\]]*/([^/\]]+)\]", block)
        rs = re.search(r"ReadSchema: struct<(.*)>", block)
        pf = re.search(r"PushedFilters: \[(.*)\]", block)
        cols = [c.split(":")[0] for c in re.split(r",(?![^<]*>)", rs.group(1))] if rs and rs.group(1) else []
        scans.append((loc.group(1) if loc else "?", cols, pf.group(1) if pf else ""))
    return nodes, scans


def main(sf_dir: str) -> None:
    from acqlens.session import build_session
    from acqlens.plans.queries import REGISTRY
    spark = build_session("local[4]")
    print("# PLANS — physical-plan facts per query\n")
    print(f"Generated by `tools/plans.py` on `{sf_dir}` (initial plans; AQE may turn a sort-merge")
    print("join into a broadcast join and coalesce partitions at run time). Columns: shuffle")
    print("exchanges, broadcast exchanges, join strategies, aggregates (hash / sort), windows, and")
    print("for every parquet scan the columns it reads and the filters pushed into it.\n")
    print("| Query | Shuffles | Broadcasts | BHJ / SMJ | Agg hash / sort | Windows | Scans (table: columns read; pushed filters) |")
    print("|---|---|---|---|---|---|---|")
    for name in sorted(REGISTRY):  # queries that store tables on their way show their last plan
        nodes, scans = summarise(plan_text(REGISTRY[name](spark, sf_dir)))
        scan_txt = "<br>".join(
            f"{t.replace('.parquet', '')}: {', '.join(c)}" + (f"; {p}" if p else "") for t, c, p in scans)
        print(f"| `{name}` | {nodes['Exchange']} | {nodes['BroadcastExchange']} | "
              f"{nodes['BroadcastHashJoin']} / {nodes['SortMergeJoin']} | "
              f"{nodes['HashAggregate'] + nodes['ObjectHashAggregate']} / {nodes['SortAggregate']} | "
              f"{nodes['Window']} | {scan_txt} |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
