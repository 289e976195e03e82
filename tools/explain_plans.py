"""Write the final physical plans of the headline queries to PLANS.md.

Usage: python tools/explain_plans.py [sf_dir]
Each query runs once so its adaptive plan is final; the report
lists its exchanges, broadcasts and Python nodes, then the plan tree.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clausework.plans.queries import QUERIES  # noqa: E402
from clausework.session import local_session  # noqa: E402

NAMES = ["tag_documents", "tag_balanced", "stance_lists", "stance_tagged", "stance_pair_model", "stance_distinct", "macro_metrics", "label_f1",
         "label_vocab", "sample_exact"]


def summary(plan: str) -> str:
    ex = re.findall(r"(?<!Broadcast)Exchange (\w+)(?:\((.*)\))?, (REPARTITION\w*|REBALANCE\w*|ENSURE\w*)", plan)
    lines = [f"- exchanges: {len(ex)}"]
    for kind, keys, why in ex:
        lines.append(f"  - {kind}({re.sub(r'#[0-9]+L?', '', keys or '')}) {why}")
    lines.append(f"- broadcast exchanges: {plan.count('BroadcastExchange')}")
    py = sum(plan.count(k) for k in ("ArrowEvalPython", "BatchEvalPython", "MapInArrow", "MapInPandas"))
    lines.append(f"- Python nodes: {py}")
    return "\n".join(lines)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    out = ["# Physical plans of the headline queries", "",
           f"Final adaptive plans at `{sf}` on local[8] (generated by `tools/explain_plans.py`).",
           "`REPARTITION_BY_NUM` is `spread` (the input is one file, so it is spread over the cores by key; a",
           "cluster scan has enough splits and skips it). `ENSURE_REQUIREMENTS` exchanges are the ones Spark adds",
           "for an aggregate or join.",
           "Jobs that ran before the query (vocabulary checkpoint, size checks) are not part of these plans.", ""]
    for name in NAMES:
        df = QUERIES[name](spark, sf)
        df.collect()          # the action runs on this query execution, so its adaptive plan is final
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        # literals of a plan may hold characters that make a text file look binary
        tree = "\n".join("".join(c for c in re.sub(r"#[0-9]+L?", "", line)[:170] if c.isprintable()) for line in plan.splitlines())
        out += [f"## {name}", "", summary(plan), "", "```", tree, "```", ""]
    spark.stop()
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
