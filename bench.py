"""Headline timings at one scale factor; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3, the median counts).

The tapes are first written as headerless ``|`` text (untimed set-up), so
the two load queries measure what the published numbers measure: scan the
text tape, clean it and write Parquet.  The other queries run the enriched
loan-level plan, the schedules and the payment table from the same text
tapes to a Parquet sink.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mortar.operators.schedule import PAYMENT_MONEY, payment_table, schedule_long  # noqa: E402
from mortar.plans.loan_level import build  # noqa: E402
from mortar.schema import FNMA  # noqa: E402
from mortar.session import build_session, scratch_path  # noqa: E402
from mortar.sinks.parquet import save_parquet, sorted_for_sink  # noqa: E402
from mortar.sources.fixtures import fnma_acquisition, fnma_performance  # noqa: E402
from mortar.sources.text import read_acquisition, read_performance, read_tape, write_tape  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None

    spark = build_session(
        f"local[{cpus}]", "mortar-bench",
        **{
            "spark.sql.shuffle.partitions": str(cpus * 4),
            "spark.driver.memory": "16g",  # local mode: the one executor's memory
        },
    )

    # Untimed set-up: the text tapes the reference reads.
    acq_txt = write_tape(fnma_acquisition(spark, sf_dir), scratch_path(spark, "bench-acq"), FNMA.acquisition)
    perf_txt = write_tape(fnma_performance(spark, sf_dir), scratch_path(spark, "bench-perf"), FNMA.performance)

    def loan_level():
        return build(read_tape(spark, perf_txt, FNMA.performance), read_tape(spark, acq_txt, FNMA.acquisition),
                     FNMA, 12)

    outputs: dict[str, str] = {}

    def out(label):
        # one folder per query and run; the repeat overwrites it
        return outputs.setdefault(label, scratch_path(spark, f"bench-out-{label}"))

    jobs = {
        "acquisition_load_write": lambda: save_parquet(read_acquisition(spark, acq_txt), out("acq")),
        "performance_load_write": lambda: save_parquet(read_performance(spark, perf_txt), out("perf")),
        "enriched_panel": lambda: save_parquet(loan_level().panel, out("panel")),
        # Sinks sort each task's output by the keys (no extra shuffle); see
        # sinks.parquet.sorted_for_sink for the total-order variant.
        "loan_outcome": lambda: save_parquet(
            sorted_for_sink(loan_level().outcome(), ["LOAN_ID"], total_order=False), out("outcome")),
        "panel_with_schedule": lambda: save_parquet(
            sorted_for_sink(loan_level().performance(), ["LOAN_ID", "ACT_DTE"], total_order=False), out("pws")),
        "schedule_long": lambda: save_parquet(schedule_long(read_acquisition(spark, acq_txt), 12), out("schd")),
        "payment_table": lambda: save_parquet(payment_table(read_acquisition(spark, acq_txt)), out("pay"),
                                              no_dictionary=PAYMENT_MONEY),
    }

    # Warm the JVM once on the smallest job.
    jobs["acquisition_load_write"]()

    timings = {}
    for name, job in jobs.items():
        runs = []
        for _ in range(max(1, repeat)):
            t0 = time.perf_counter()
            job()
            runs.append(time.perf_counter() - t0)
        timings[name] = round(median(runs), 3)
        print(f"{name}: {timings[name]:.3f}s of {[round(r, 2) for r in runs]}", file=sys.stderr)

    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
