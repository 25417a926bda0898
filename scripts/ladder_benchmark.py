"""The original experimental procedure, on Spark: every job over every size of the ladder.

For each prefix size of the time-ordered raw log (``write_size_ladder``): run
J1 (clean + store) and the four queries ``--runs`` times, append one timing row
per run to a Parquet timing log, then print the performance summary
(runs, mean seconds, rows, speed = rows / second, efficiency = speed / core).

Usage: python scripts/ladder_benchmark.py <raw_csv_or_sf_dir> <work_dir> [--runs N] [--cores N]
                                          [--fractions 1/1000,1/10,1/1]
With an sf directory, the raw log is derived from its lineitem table first.
"""

from __future__ import annotations

import argparse
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripgrid import catalog  # noqa: E402
from tripgrid import schema as S  # noqa: E402
from tripgrid.operators.sample import LADDER_FRACTIONS, write_size_ladder  # noqa: E402
from tripgrid.plans.benchmark import performance_summary, run_process  # noqa: E402
from tripgrid.plans.frequent_routes import frequent_routes, frequent_routes_seasonal  # noqa: E402
from tripgrid.plans.profitable_areas import profitable_areas, profitable_areas_seasonal  # noqa: E402
from tripgrid.session import local_session  # noqa: E402
from tripgrid.sources.fixture import raw_trips  # noqa: E402
from tripgrid.sources.trips_io import append_timing, read_raw_trips, read_timings, read_trips  # noqa: E402


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("source")
    ap.add_argument("work")
    ap.add_argument("--runs", type=int, default=5)
    ap.add_argument("--cores", type=int, default=8)
    ap.add_argument("--fractions", default=",".join(f"{n}/{d}" for n, d in LADDER_FRACTIONS))
    args = ap.parse_args()
    fractions = [tuple(int(x) for x in f.split("/")) for f in args.fractions.split(",")]

    spark = local_session(args.cores, max(args.cores, 8), checkpoint_dir=f"{args.work}/ckpt")
    if os.path.exists(f"{args.source}/lineitem.parquet"):
        raw = raw_trips(spark, args.source).drop("k")
    else:
        raw = read_raw_trips(spark, args.source)
    ladder = write_size_ladder(raw, f"{args.work}/ladder", (S.PICKUP_TIME, S.MEDALLION, S.LICENSE), fractions)
    timings = f"{args.work}/timings"
    queries = {
        "frequent_routes": lambda t: frequent_routes(t, catalog.AT),
        "frequent_routes_day": lambda t: frequent_routes_seasonal(
            t, catalog.SEASON_MONTH, catalog.SEASON_WEEKDAY, catalog.SEASON_HHMM
        ),
        "profitable_areas": lambda t: profitable_areas(t, catalog.AT),
        "profitable_areas_day": lambda t: profitable_areas_seasonal(
            t, catalog.AREA_WEEKDAY, catalog.AREA_MMDD, catalog.AREA_HHMM
        ),
    }
    for size, csv_path in ladder:
        label = str(size)
        for run in range(args.runs):
            out = f"{args.work}/processed/{size}_{run}"
            seconds = run_process(spark, csv_path, out)
            append_timing(spark, timings, "procesamiento", seconds, rows=size, cores=args.cores, label=label)
        trips = read_trips(spark, f"{args.work}/processed/{size}_0")
        for name, build in queries.items():
            for run in range(args.runs):
                start = time.perf_counter()
                build(trips).collect()  # at most 10 rows
                append_timing(
                    spark, timings, name, time.perf_counter() - start, rows=size, cores=args.cores, label=label
                )
    performance_summary(read_timings(spark, timings)).orderBy("trabajo", "filas").show(100, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
