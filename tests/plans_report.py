"""Write PLANS.md: executed (final adaptive) physical plans of the headline queries.

Usage: python tests/plans_report.py [sf_dir]   (long expressions are shortened)
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

QUERIES = ["silver_table", "fact_postings", "incremental_capture", "page_cards", "quality_report"]


def shorten(line: str, width: int = 160) -> str:
    line = re.sub(r"\[[^\[\]]{120,}\]", "[…]", line)
    return line if len(line) <= width else line[: width - 1] + "…"


def main() -> None:
    from vacanta.session import local_session
    import __spark_entry__ as E

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(shuffle_partitions=16)
    out = ["# Executed plans", "",
           f"Final adaptive physical plans after a run at `{sf}` on `local[8]` (generated by "
           "`tests/plans_report.py`; long expression lists shortened to `[…]`).", ""]
    for name in QUERIES:
        df = E.queries()[name](spark, sf)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        lines = [shorten(l) for l in plan.split("\n") if l.strip() and not l.startswith(")")]
        out += [f"## {name}", "", "```", *lines, "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
