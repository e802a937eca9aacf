"""Run queries and print what their final plans contain.

usage: python tools/show_plan.py FOLDER QUERY ... [--full]
"""

from __future__ import annotations

import pathlib
import re
import sys
from collections import Counter

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from tillsight import registry  # noqa: E402
from tillsight.session import local_session  # noqa: E402

NODES = ("FileScan", "ReusedExchange", "ReusedSubquery", "BroadcastExchange", "Exchange",
         "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
         "CartesianProduct", "HashAggregate", "SortAggregate", "ObjectHashAggregate", "Window",
         "WindowGroupLimit", "Expand", "TakeOrderedAndProject", "Sort", "BatchEvalPython")


def main() -> None:
    full = "--full" in sys.argv
    folder, *names = [a for a in sys.argv[1:] if a != "--full"]
    spark = local_session("plan")
    for name in names or registry.QUERIES:
        frame = registry.QUERIES[name](spark, folder)
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        found = Counter(m for line in final.splitlines()
                        for m in re.findall(r"^[\s:+|*()0-9-]*\s*(\w+)", line) if m in NODES)
        print(f"{name}: {dict(found)}")
        if full:
            print(plan)


if __name__ == "__main__":
    main()
