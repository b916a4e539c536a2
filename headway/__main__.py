"""Command line: the full run.

    python -m headway files --incidents DIR --weather FILE --forecast FILE --out DIR [--year 2024 ...]
    python -m headway fixtures --sf-dir /root/testdata/sf0.1 --out DIR

Prints the per-step seconds as one JSON line.
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="headway", description="Service-reliability pipeline on Spark")
    sub = ap.add_subparsers(dest="mode", required=True)
    f = sub.add_parser("files", help="incident CSV files + hourly weather and forecast documents")
    f.add_argument("--incidents", required=True, help="folder of yearly incident CSV files")
    f.add_argument("--weather", required=True, help="hourly weather document(s) for the period")
    f.add_argument("--forecast", required=True, help="7-day hourly forecast document")
    f.add_argument("--cache", default=None, help="folder of the raw-row cache (only new and changed files are read)")
    f.add_argument("--skip-unreadable", action="store_true", help="leave out files of other formats, with a warning")
    f.add_argument("--year", type=int, action="append", help="year(s) to read (default 2024)")
    x = sub.add_parser("fixtures", help="the driver's parquet tables")
    x.add_argument("--sf-dir", required=True)
    for p in (f, x):
        p.add_argument("--out", required=True, help="output folder (Parquet tables)")
        p.add_argument("--publish", action="store_true", help="write a version folder under --out and swap its manifest last")
        p.add_argument("--trees", type=int, default=200, help="trees per boosted model (default 200)")
        p.add_argument("--format", default="parquet", choices=["parquet", "csv"])
        p.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    a = ap.parse_args(argv)

    from headway.plans.full_run import run, run_files, run_published
    from headway.session import get_spark

    spark = get_spark(a.master)
    kw = {"n_trees": a.trees, "fmt": a.format}
    if a.mode == "files":
        runner = run_files
        kw |= {"incidents_dir": a.incidents, "weather_path": a.weather, "forecast_path": a.forecast, "years": tuple(a.year or [2024])}
        kw |= {"cache_dir": a.cache, "skip_unreadable": a.skip_unreadable}
    else:
        runner = run
        kw |= {"sf_dir": a.sf_dir}
    if a.publish:
        _, seconds = run_published(spark, a.out, runner, **kw)
    else:
        _, seconds = runner(spark, out_dir=a.out, **kw)
    print(json.dumps(seconds))
    return 0


if __name__ == "__main__":
    sys.exit(main())
