"""Benchmark: the full pipeline over $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries": {step: sec}, "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
TREES = int(os.environ.get("BENCH_TREES", "200"))
WARMUP = os.environ.get("BENCH_WARMUP", "1") != "0"


def main() -> None:
    from pyspark.sql import SparkSession

    from headway.plans.full_run import run
    from headway.session import BASE_CONF

    b = SparkSession.builder.master(f"local[{CPUS}]").appName("headway-bench")
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    spark = (
        b.config("spark.sql.shuffle.partitions", str(CPUS))
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(os.path.join(SF_DIR, "region.parquet")).count()
    # Untimed warm-up (JIT, class loading, code generation): the same pipeline on
    # the smallest fixture with 1 tree.  Disclosed in the output; BENCH_WARMUP=0 skips it.
    warm_dir = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001")
    warmup = WARMUP and os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(SF_DIR)
    if warmup:
        run(spark, warm_dir, out_dir=None, n_trees=1, with_cv_metrics=True, release=True)

    out_dir = tempfile.mkdtemp(prefix="headway-bench-")
    t0 = time.perf_counter()
    _, seconds = run(spark, SF_DIR, out_dir=out_dir, n_trees=TREES, with_cv_metrics=True, size_conf=False)
    total = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "full_run_wall_clock",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": float(m.group(1)) if m else SF_DIR,
                "cpus": CPUS,
                "trees_per_model": TREES,
                "output": "Parquet tables and models written",
                "warmup": "untimed pass at sf0.001, 1 tree" if warmup else "none",
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
