"""Command lines matching the original jobs (run as ``python -m tripgrid`` or, installed, ``tripgrid``).

    process              <raw_csv> <out_parquet> [--timings PATH] [--layout by_date|flat] [--cluster counts|rebalance|local]
                         [--quarantine PATH]
    frequent-routes      <parquet> <YYYY-MM-DD> <HH:MM>
    frequent-routes-day  <parquet> <month name> <weekday name> <HH:MM> [--year 2013]
    profitable-areas     <parquet> <YYYY-MM-DD> <HH:MM>
    profitable-areas-day <parquet> <weekday name> <MM-DD> <HH:MM> [--year 2013]
    grid                 <out_csv>
    scan-benchmark       <raw_csv> <scratch_dir>
    summary              <timings_path>

Query commands print the ranked rows and, with ``--results PATH``, append the
original result line (with the elapsed seconds) to a text sink; with
``--timings PATH`` they also append a timing row. No master is set here:
the launcher's configuration (``spark-defaults.conf``, ``--master`` of the
environment) decides where the job runs.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import sys
import time

from pyspark.sql import SparkSession

from .functions.time import band_before, instant, minus_minutes, parse_time
from .operators.grid import grid_cells
from .plans.benchmark import performance_summary, run_process, scan_benchmark
from .plans.frequent_routes import frequent_routes, frequent_routes_seasonal
from .plans.profitable_areas import AMOUNTS, profitable_areas, profitable_areas_seasonal, seasonal_instant
from .plans.result_line import area_line, route_line
from .session import SQL_CONF, STATIC_CONF
from .sources.trips_io import CLUSTERINGS, append_timing, open_trips, read_timings, read_trips, session_cores, write_result_line


def _session() -> SparkSession:
    builder = SparkSession.builder.appName("tripgrid")
    for key, value in STATIC_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in SQL_CONF.items():
        spark.conf.set(key, value)
    return spark


def _finish(spark, args, ranked, line_fn, name, start, end, t0) -> None:
    rows = ranked.collect()  # at most k rows
    elapsed = time.perf_counter() - t0
    for r in rows:
        # Amounts are printed in currency units; the result line has none.
        print(", ".join(f"{k}={v / 100 if k in AMOUNTS and v is not None else v}" for k, v in r.asDict().items()))
    print(f"elapsed {elapsed:.3f}s")
    if args.results:
        # Format from the k rows already fetched instead of running the query again.
        fetched = spark.createDataFrame(rows, ranked.schema)
        write_result_line(line_fn(fetched, name, start, end, elapsed), args.results)
    if args.timings:
        append_timing(
            spark, args.timings, name, elapsed, read_trips(spark, args.parquet).count(), session_cores(spark), args.parquet
        )


def _frequent_routes(spark, args) -> None:
    t0 = time.perf_counter()
    at = instant(args.date, args.hhmm)
    ranked = frequent_routes(open_trips(spark, args.parquet), at, args.minutes, args.k)
    _finish(spark, args, ranked, route_line, "frequent_routes", minus_minutes(at, args.minutes), at, t0)


def _frequent_routes_day(spark, args) -> None:
    t0 = time.perf_counter()
    ranked = frequent_routes_seasonal(
        open_trips(spark, args.parquet), args.month, args.weekday, args.hhmm,
        year=args.year, minutes=args.minutes, k=args.k, compat=args.compat,
    )
    lo, hi = band_before(parse_time(args.hhmm), args.minutes)
    _finish(spark, args, ranked, route_line, "frequent_routes_day", lo, hi, t0)


def _profitable_areas(spark, args) -> None:
    t0 = time.perf_counter()
    at = instant(args.date, args.hhmm)
    ranked = profitable_areas(open_trips(spark, args.parquet), at, k=args.k)
    _finish(spark, args, ranked, area_line, "profitable_areas", minus_minutes(at, 30), at, t0)


def _profitable_areas_day(spark, args) -> None:
    t0 = time.perf_counter()
    ref = seasonal_instant(args.mmdd, args.hhmm, args.year)
    ranked = profitable_areas_seasonal(
        open_trips(spark, args.parquet), args.weekday, args.mmdd, args.hhmm,
        year=args.year, k=args.k, compat=args.compat,
    )
    _finish(spark, args, ranked, area_line, "profitable_areas_day", ref - _dt.timedelta(minutes=30), ref, t0)


def _process(spark, args) -> None:
    seconds = run_process(
        spark, args.raw_csv, args.out, timing_path=args.timings, mode=args.mode,
        layout=args.layout, compat=args.compat, cluster=args.cluster, quarantine_path=args.quarantine,
    )
    print(f"processed in {seconds:.3f}s")


def _grid(spark, args) -> None:
    grid_cells(spark).write.mode(args.mode).option("header", "true").csv(args.out)


def _scan_benchmark(spark, args) -> None:
    scan_benchmark(spark, args.raw_csv, f"{args.scratch.rstrip('/')}/parquet").show(truncate=False)


def _summary(spark, args) -> None:
    performance_summary(read_timings(spark, args.timings_path)).show(truncate=False)


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tripgrid", description=__doc__.split("\n\n")[0])
    sub = p.add_subparsers(dest="command", required=True)

    def query(name, fn, *positional):
        q = sub.add_parser(name)
        q.add_argument("parquet")
        for arg in positional:
            q.add_argument(arg)
        q.add_argument("--k", type=int, default=10)
        q.add_argument("--results", help="text sink the result line is appended to")
        q.add_argument("--timings", help="Parquet timing log to append to")
        q.set_defaults(fn=fn)
        return q

    query("frequent-routes", _frequent_routes, "date", "hhmm").add_argument("--minutes", type=float, default=30)
    q = query("frequent-routes-day", _frequent_routes_day, "month", "weekday", "hhmm")
    q.add_argument("--year", type=int, default=2013)
    q.add_argument("--minutes", type=float, default=30)
    q.add_argument("--compat", action="store_true")
    query("profitable-areas", _profitable_areas, "date", "hhmm")
    q = query("profitable-areas-day", _profitable_areas_day, "weekday", "mmdd", "hhmm")
    q.add_argument("--year", type=int, default=2013)
    q.add_argument("--compat", action="store_true")

    q = sub.add_parser("process")
    q.add_argument("raw_csv")
    q.add_argument("out")
    q.add_argument("--timings")
    q.add_argument("--layout", default="by_date", choices=["by_date", "flat"])
    q.add_argument("--quarantine", help="Parquet folder for malformed records")
    q.add_argument("--cluster", default="counts", choices=CLUSTERINGS)
    q.add_argument("--mode", default="errorifexists")
    q.add_argument("--compat", action="store_true")
    q.set_defaults(fn=_process)

    q = sub.add_parser("grid")
    q.add_argument("out")
    q.add_argument("--mode", default="errorifexists")
    q.set_defaults(fn=_grid)

    q = sub.add_parser("scan-benchmark")
    q.add_argument("raw_csv")
    q.add_argument("scratch")
    q.set_defaults(fn=_scan_benchmark)

    q = sub.add_parser("summary")
    q.add_argument("timings_path")
    q.set_defaults(fn=_summary)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = build_parser().parse_args(argv)
    args.fn(spark or _session(), args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
