"""Benchmark: the whole bonus refresh (M1-M15, P1) on the test tables.

Runs on local[$BENCH_CPUS] against $BENCH_SF_DIR (default sf0.1), writes
every mart with its load mode into a fresh scratch folder and prints one JSON
line with per-mart seconds (plan building + compute + write) and the total.
One untimed refresh on the smallest test scale runs first, so JVM start-up and
first-time code generation are not counted as work; its time is reported as
``warmup_sec``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from callcredit.functions.rules import TEST_AS_OF, TEST_RULES  # noqa: E402
from callcredit.plans.refresh import refresh_all  # noqa: E402
from callcredit.session import build_session  # noqa: E402
from callcredit.sources.fixtures import load_inputs  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus, 8), app="callcredit-bench")
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    t0 = time.time()
    if os.path.isdir(warm_dir):
        refresh_all(spark, load_inputs(spark, warm_dir), TEST_AS_OF,
                    tempfile.mkdtemp(prefix="callcredit-warmup-"), TEST_RULES)
    warmup = time.time() - t0
    scratch = tempfile.mkdtemp(prefix="callcredit-bench-")
    inputs = load_inputs(spark, sf_dir)
    timings: dict[str, float] = {}
    t0 = time.time()
    refresh_all(spark, inputs, TEST_AS_OF, scratch, TEST_RULES, timings=timings)
    total = time.time() - t0
    print(json.dumps({"metric": "bonus_refresh_total", "value": round(total, 3), "unit": "sec",
                      "queries": timings, "sf": sf, "cpus": cpus, "warmup_sec": round(warmup, 3)}))
    spark.stop()


if __name__ == "__main__":
    main()
