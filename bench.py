"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is executed in full with the ``noop`` sink (no collect to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from chatloom.session import get_spark  # noqa: E402
from chatloom.plans import registry  # noqa: E402

HEADLINE = [
    "window_summary",        # flagship: dialogs -> vocab -> tokens -> windows -> masks
    "build_windows",         # full windows of conversations, rendered
    "build_windows_text",    # text path over documents (the largest input)
    "build_vocab",
    "encode_text",
    "normalize_sharegpt",
    "scan_directory",
    "batch_windows",
    "bigram_nll",
    "masked_batch_loss",
    "draw_token",
    "rolling_metrics",
    "early_stop_epoch",
    "incremental_load",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    conf = {"spark.sql.shuffle.partitions": str(max(8, int(cpus) * 2))}
    if os.environ.get("BENCH_EVENT_LOG"):
        # stage / task times without the UI: Spark's event log in a scratch folder
        conf.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]})
    spark = get_spark(f"local[{cpus}]", "chatloom-bench", conf)
    qs = registry.queries()
    # untimed warm-up: JVM code paths and Python workers (not query cost)
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        qs["window_summary"](spark, small).collect()
    spark.catalog.clearCache()
    times = {}
    for name in names:
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        spark.catalog.clearCache()
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
