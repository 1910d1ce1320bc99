"""Write PLANS.md: executed (adaptive) physical plans of the headline queries.

Run with automatic broadcast off (``--scale``) to see the shuffle plans a
large input would get: every join is then a sort-merge join. Keeps the operator tree and the lines that matter
for scale: exchanges, pushed filters, read schemas, join types.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from tiermart.plans import registry  # noqa: E402
from tiermart.session import local_session  # noqa: E402

KEEP = re.compile(r"^(Arguments: (hashpartitioning|rangepartitioning|SinglePartition|HashedRelation)|PushedFilters|"
                  r"ReadSchema|Join type|Keys|Functions)")


def summarize(plan: str) -> str:
    lines = plan.splitlines()
    tree, details, node = [], [], None
    in_tree = True
    for line in lines:
        if in_tree:
            if line.startswith("(") and line[1:2].isdigit():
                in_tree = False
            elif line.strip():
                tree.append(line)
                continue
        if line.startswith("(") and line[1:2].isdigit():
            node = line.strip()
        elif KEEP.match(line.strip()) and node:
            details.append(f"{node}: {line.strip()[:220]}")
    return "\n".join(tree) + "\n\n" + "\n".join(details)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    out = ["# Physical plans (adaptive, executed) with automatic broadcast off",
           "", f"Input `{sf_dir}`, `tools/show_plans.py`. Nothing hints a broadcast.", ""]
    for name in HEADLINE:
        df = registry.QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        out += [f"## {name}", "", "```", summarize(plan), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main()
