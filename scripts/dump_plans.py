"""Write the final (post-AQE) physical plans of the main queries to PLANS.md.

usage: python scripts/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from onomata import queries as Q  # noqa: E402
from onomata.plans.strategy import physical_plan  # noqa: E402
from onomata.session import local_session  # noqa: E402

MAIN = (
    "entity_top_10",
    "entity_counts_shuffle",
    "entity_mentions_shuffle",
    "entity_phrase_counts",
    "entity_type_stats",
    "processing_stats",
    "feed_status",
    "post_tokens",
)


def _tree(plan: str) -> str:
    final = plan.split("== Initial Plan ==")[0].rstrip().removesuffix("+-").rstrip()
    joined: list[str] = []
    for line in final.split("\n"):
        # a newline literal inside an expression splits a plan line; glue it back
        if joined and not re.match(r"^\s*(\+-|:|AdaptiveSparkPlan|==|\w+Stage|\*?\(\d+\)|[A-Z])", line):
            joined[-1] += "\\n" + line
        else:
            joined.append(line)
    lines = []
    for line in joined:
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        if len(line) > 160:
            line = line[:157] + "..."
        lines.append(line)
    return "\n".join(lines)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(shuffle_partitions=16)
    out = [
        "# Physical plans",
        "",
        f"Final adaptive plans after one run at `{sf_dir}` on `local[*]`, 16 shuffle partitions",
        "(generated by `scripts/dump_plans.py`; expression ids removed, long lines cut).",
        "",
    ]
    for name in MAIN:
        df = Q.QUERIES[name](spark, sf_dir)
        df.collect()  # run this DataFrame's own plan so the adaptive plan is final
        out += [f"## {name}", "", "```", _tree(physical_plan(df)), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
