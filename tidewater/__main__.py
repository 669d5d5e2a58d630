"""Command line: build the models, run the checks, print a report.

  python -m tidewater layout --tables DIR --out DIR [--buckets N]
  python -m tidewater build  --tables DIR --out DIR [--as-of TS] [--threads N]
  python -m tidewater check  --tables DIR [--marts DIR] [--as-of TS]
  python -m tidewater report NAME --tables DIR [--marts DIR] [--from DAY --to DAY] [--as-of TS] [--limit N] [--out DIR]

``--tables`` is a folder of the given TPC-H-style Parquet tables; use
``--raw`` instead for a folder of raw_* source tables, or ``--layout`` for a
folder that ``layout`` wrote, where orders, items and payments are bucketed by
order.  ``--marts`` is a folder that ``build`` wrote: reports and checks then read
the newest build in it.  ``build`` writes all models in dependency order (facts
partitioned by month), publishes them together and then runs the 57 checks over
the written tables, like a build-then-test run; it exits 1 when a check fails.
``--from`` and ``--to`` (exclusive) bound a report on the order lines by date; of
stored marts only the months in between are read.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from tidewater import ModelGraph, RunParams, from_raw_parquet, from_test_tables
from tidewater.session import build_session
from tidewater.sources.bucketed import lay_out, open_layout


def _graph(args) -> ModelGraph:
    spark = build_session(app_name=f"tidewater-{args.cmd}")
    if args.layout:
        raw = open_layout(spark, args.layout)
    else:
        raw = from_raw_parquet(spark, args.raw) if args.raw else from_test_tables(spark, args.tables)
    as_of = getattr(args, "as_of", None)
    params = RunParams(as_of=dt.datetime.fromisoformat(as_of)) if as_of else RunParams()
    return ModelGraph(spark, raw, params)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tidewater")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("layout", "build", "check", "report"):
        p = sub.add_parser(name)
        src = p.add_mutually_exclusive_group(required=True)
        src.add_argument("--tables", help="folder of the given TPC-H-style Parquet tables")
        src.add_argument("--raw", help="folder of raw_* source tables")
        src.add_argument("--layout", help="folder of bucketed raw tables")
        if name == "layout":
            p.add_argument("--out", required=True, help="new folder for the bucketed raw tables")
            p.add_argument("--buckets", type=int, help="buckets of each table (default: the shuffle partitions)")
            continue
        p.add_argument("--as-of", help="run time, e.g. 2001-08-02T00:00:00 (default: the test as-of)")
        if name in ("check", "report"):
            p.add_argument("--marts", help="folder of built models to read instead of deriving them")
        if name == "build":
            p.add_argument("--out", required=True, help="output folder for the model tables")
            p.add_argument("--threads", type=int, default=4)
        if name == "report":
            p.add_argument("name")
            p.add_argument("--from", dest="since", type=dt.date.fromisoformat, help="first day")
            p.add_argument("--to", dest="until", type=dt.date.fromisoformat, help="day after the last")
            p.add_argument("--limit", type=int, help="print only so many rows (default: all)")
            p.add_argument("--out", help="write the report here as CSV instead of printing it")
    args = ap.parse_args(argv)
    if args.cmd == "report" and (args.since is None) != (args.until is None):
        ap.error("--from and --to go together")
    graph = _graph(args)
    if args.cmd == "layout":
        lay_out(graph.raw, args.out, args.buckets)
        print(f"laid out: {args.out}")
        return 0
    if getattr(args, "marts", None):
        graph.open_models(args.marts)
    if args.cmd == "report":
        report = graph.report_between(args.name, args.since, args.until) if args.since else graph.report(args.name)
        if args.out:
            report.write.csv(args.out, header=True)
            return 0
        rows = report.count()
        report.show(rows if args.limit is None else args.limit, truncate=False)
        if args.limit is not None and rows > args.limit:
            print(f"{args.limit} of {rows} rows shown")
        return 0
    if args.cmd == "build":
        for name, path in graph.write_models(args.out, threads=args.threads).items():
            print(f"built {name}: {path}")
    results = graph.check_results(materialize=args.cmd == "check")
    results.orderBy("model", "test_name").show(results.count(), truncate=False)
    failed = results.where("failures > 0").count()
    print(f"{failed} failing check(s)")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
