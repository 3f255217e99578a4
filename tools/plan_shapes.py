"""Print the physical operator trees of the headline paths.

Usage: python tools/plan_shapes.py [sf_dir]

Adaptive execution and broadcast joins are switched off so the trees show
the shape a large input gets.  Only operator names and key arguments are
kept, one line per node.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mortar.operators.schedule import payment_table, schedule_long  # noqa: E402
from mortar.plans.loan_level import build  # noqa: E402
from mortar.schema import FNMA  # noqa: E402
from mortar.session import build_session, scratch_path  # noqa: E402
from mortar.sources.fixtures import fnma_acquisition, fnma_performance  # noqa: E402
from mortar.sources.text import read_acquisition, read_tape, write_tape  # noqa: E402

_NODE = re.compile(r"^(?P<indent>[\s:+\-]*)(?:\*\(\d+\)\s*)?(?P<name>[A-Za-z]+(?: [A-Za-z]+)?)(?P<rest>.*)$")
_KEEP_ARGS = ("Exchange", "SortMergeJoin", "BroadcastHashJoin", "HashAggregate")


def shape(df) -> str:
    lines = []
    for line in df._jdf.queryExecution().executedPlan().treeString().splitlines():
        m = _NODE.match(line)
        if not m:
            continue
        name = m.group("name")
        rest = m.group("rest")
        if name.startswith(_KEEP_ARGS):
            rest = re.sub(r"#\d+", "", rest)[:70]
        elif name.startswith("FileScan"):
            cols = re.search(r"\[([^\]]*)\]", rest)
            n = 0
            if cols:
                items = cols.group(1).split(",")
                more = re.search(r"(\d+) more fields", cols.group(1))
                n = len(items) - 1 + int(more.group(1)) if more else len(items)
            rest = f" ({n} columns)"
        else:
            rest = ""
        lines.append(f"{m.group('indent')}{name}{rest}")
    return "\n".join(lines)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", "mortar-plans", **{
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    })
    acq = write_tape(fnma_acquisition(spark, sf), scratch_path(spark, "plans-acq"), FNMA.acquisition)
    perf = write_tape(fnma_performance(spark, sf), scratch_path(spark, "plans-perf"), FNMA.performance)
    level = build(read_tape(spark, perf, FNMA.performance), read_tape(spark, acq, FNMA.acquisition), FNMA, 12)
    loans = read_acquisition(spark, acq)
    for label, df in [
        ("enriched panel", level.panel),
        ("loan outcome", level.outcome()),
        ("panel with schedule", level.performance()),
        ("schedule long", schedule_long(loans, 12)),
        ("payment table", payment_table(loans)),
    ]:
        print(f"== {label}\n{shape(df)}\n")
    spark.stop()


if __name__ == "__main__":
    main()
