"""Bench: run the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query is executed in full with the ``noop`` sink (every row is
produced, nothing is collected to the driver), after an untimed warm-up
pass on the smallest scale factor; each query's time is the best of
``$BENCH_REPEATS`` (default 2) runs.  Prints one JSON line:

    {"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Set ``BENCH_EVENT_LOG`` to a folder to keep Spark's event log (stage and
task times) for the run.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# Headline keys beyond the ones flagged ``bench=True`` in the registry.
EXTRA = ["model_train_eval"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    conf = {}
    if os.environ.get("BENCH_EVENT_LOG"):
        conf = {"spark__eventLog__enabled": "true", "spark__eventLog__dir": os.environ["BENCH_EVENT_LOG"]}

    from groundstop.plans import BENCH, QUERIES
    from groundstop.session import local_session

    spark = local_session("groundstop-bench", cpus=cpus, **conf)
    keys = list(BENCH) + [k for k in EXTRA if k not in BENCH]
    only = os.environ.get("BENCH_ONLY")
    if only:
        keys = [k for k in keys if k in only.split(",")]

    # Warm-up (not timed): every headline query once on the smallest scale
    # factor, so that JIT and whole-stage-codegen compilation are not billed
    # to the first query that happens to use a plan shape.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", os.path.join(os.path.dirname(sf_dir), "sf0.001"))
    if os.path.isdir(warm_dir) and os.environ.get("BENCH_WARMUP", "1") != "0":
        for key in keys:
            QUERIES[key](spark, warm_dir).write.format("noop").mode("overwrite").save()
    else:
        warm_dir = None
    QUERIES["count_all"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    # Best of ``repeats`` runs per query: the VM's timing noise is large
    # next to these few-second queries.
    repeats = max(1, int(os.environ.get("BENCH_REPEATS", "2")))
    times: dict[str, float] = {}
    for key in keys:
        runs = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[key] = round(min(runs), 3)
        print(f"{key}: {times[key]:.2f}s (runs {[round(r, 2) for r in runs]})", file=sys.stderr)
    spark.stop()

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": cpus,
        "warmup": os.path.basename(warm_dir) if warm_dir else None,
        "repeats": repeats,
    }))


if __name__ == "__main__":
    main()
