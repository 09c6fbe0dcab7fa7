"""Summarise the physical plan of every query of the library into PLANS.md.

Usage: python scripts/plan_audit.py [sf_dir]
For each query: exchanges (shuffles, incl. AQE's initial plan), join
strategies, WindowGroupLimits, and per scan the pushed filters and the read
schema.  Queries that write files (pipeline, stream) are described by their
final read.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from talentflow.session import local_session
    from talentflow.plans.queries import QUERIES

    spark = local_session()
    out = [
        "# Physical plans of the registered queries",
        "",
        f"Generated by `scripts/plan_audit.py` at `{sf_dir}` (AQE initial plans; AQE may still turn a",
        "sort-merge join into a broadcast join at run time from measured sizes).",
        "`RoundRobin` exchanges come from `spark.talentflow.spreadInputs`, which the local session sets;",
        "without the setting they are not there.",
        "",
        "| query | shuffles | joins | window-group limits | scans: pushed filters / read schema |",
        "|---|---|---|---|---|",
    ]
    for name, q in QUERIES.items():
        plan = q(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        shuffles = re.findall(r"Exchange (\w+)", plan)
        kinds = {}
        for k in shuffles:
            kinds[k] = kinds.get(k, 0) + 1
        joins = {j: plan.count(j) for j in ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct") if plan.count(j)}
        scans = []
        for s in re.findall(r"FileScan \w+[^\n]*", plan):
            loc = re.search(r"\[file:[^\]]*/([\w=.-]+)\]", s)
            pf = re.search(r"PushedFilters: (\[.*?\]?), ReadSchema", s)  # Spark may cut a long list short
            rs = re.search(r"ReadSchema: (struct<[^\n]*?>)(,|$)", s)
            scans.append(f"`{loc.group(1) if loc else '?'}`: {pf.group(1) if pf else '[]'} / `{(rs.group(1) if rs else '')[:110]}`")
        out.append(
            f"| `{name}` | {', '.join(f'{v}× {k}' for k, v in kinds.items()) or 'none'} | "
            f"{', '.join(f'{v}× {k}' for k, v in joins.items()) or 'none'} | {plan.count('WindowGroupLimit')} | "
            + "<br>".join(scans).replace("|", "\\|")
            + " |"
        )
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out) + "\n")
    print("\n".join(out))


if __name__ == "__main__":
    main()
