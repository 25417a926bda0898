"""Benchmark: the original workflow on the driver's data.

1. setup (untimed): derive the raw trip log from ``lineitem`` and write it as
   headerless CSV, the input format of the original processing job;
2. ``j1_process``: read CSV -> clean -> grid cells + weekday -> Parquet in the
   ``by_date`` layout (``j1_process_flat``: the flat layout the original wrote),
   median of 3 after a warm-up;
3. the four ranked queries over the stored Parquet table, opened by its file
   index, plus the CSV-vs-Parquet ``count(*)`` of the raw log (J7).

Each query runs once to warm up, then ``BENCH_REPEAT`` times; the median is
reported. Spark's event log (in the run's scratch folder) gives the bytes each
query reads from storage and writes to shuffle, per run. Prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 5).
"""

from __future__ import annotations

import glob
import io
import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tripgrid import catalog  # noqa: E402
from tripgrid.plans.frequent_routes import frequent_routes, frequent_routes_seasonal  # noqa: E402
from tripgrid.plans.profitable_areas import profitable_areas, profitable_areas_seasonal  # noqa: E402
from tripgrid.session import local_session  # noqa: E402
from tripgrid.sources.fixture import raw_trips  # noqa: E402
from tripgrid.sources.trips_io import open_trips, read_raw_trips, read_trips, write_trips  # noqa: E402
from tripgrid.operators.clean import process_trips  # noqa: E402


def _event_lines(event_dir: str):
    """Lines of the Spark event log (zstd-compressed by default in Spark 4)."""
    for path in sorted(glob.glob(f"{event_dir}/*/events_*") + glob.glob(f"{event_dir}/*.zstd")):
        with open(path, "rb") as fh:
            if path.endswith(".zstd"):
                import zstandard

                yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
            else:
                yield from io.TextIOWrapper(fh, encoding="utf-8")


def _bytes_per_group(event_dir: str) -> dict[str, dict[str, int]]:
    """Input bytes read and shuffle bytes written by the tasks of each job group."""
    stage_group: dict[int, str] = {}
    totals: dict[str, dict[str, int]] = {}
    for line in _event_lines(event_dir):
        e = json.loads(line)
        kind = e.get("Event")
        if kind == "SparkListenerJobStart":
            group = (e.get("Properties") or {}).get("spark.jobGroup.id")
            if group:
                for sid in e.get("Stage IDs", []):
                    stage_group[sid] = group
        elif kind == "SparkListenerTaskEnd":
            group = stage_group.get(e.get("Stage ID"))
            metrics = e.get("Task Metrics") or {}
            if group:
                t = totals.setdefault(group, {"input": 0, "shuffle": 0})
                t["input"] += (metrics.get("Input Metrics") or {}).get("Bytes Read", 0)
                t["shuffle"] += (metrics.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
    return totals


def _median_seconds(action, repeat: int) -> float:
    action()  # warm-up
    times = []
    for _ in range(repeat):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return statistics.median(times)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    work = tempfile.mkdtemp(prefix="tripgrid-bench-")
    event_dir = f"{work}/events"
    os.makedirs(event_dir)
    spark = local_session(
        cpus, shuffle_partitions=max(cpus, 8), checkpoint_dir=f"{work}/ckpt", event_log_dir=event_dir
    )

    # Setup: the raw CSV log (the original pipeline's input).
    raw = raw_trips(spark, sf_dir).drop("k")
    csv_path = f"{work}/raw_csv"
    raw.write.option("header", "false").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(csv_path)
    n_raw = spark.read.csv(csv_path).count()
    # The same raw log as flat Snappy Parquet, for the CSV-vs-Parquet count (J7).
    raw_parquet = f"{work}/raw_parquet"
    spark.read.schema(raw.schema).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(csv_path).write.parquet(
        raw_parquet
    )

    # J1: clean + enrich + store. Warm-up run (its output is the table the queries
    # read), then the median of 3 runs into fresh folders, for both layouts.
    out_path = f"{work}/trips"
    write_trips(process_trips(read_raw_trips(spark, csv_path)), out_path, layout="by_date")
    j1 = {}
    for layout in ("by_date", "flat"):
        runs = []
        for i in range(3):
            start = time.perf_counter()
            write_trips(process_trips(read_raw_trips(spark, csv_path)), f"{work}/j1_{layout}_{i}", layout=layout)
            runs.append(time.perf_counter() - start)
        j1[layout] = statistics.median(runs)
    t_process = j1["by_date"]
    n_clean = read_trips(spark, out_path).count()

    def trips():
        # Finding the files belongs to a query, as it does for a user: each run asks the table's file index.
        return open_trips(spark, out_path)

    at = catalog.AT
    queries = {
        "q1_frequent_routes": lambda: frequent_routes(trips(), at).collect(),
        "q1s_frequent_routes_seasonal": lambda: frequent_routes_seasonal(
            trips(), catalog.SEASON_MONTH, catalog.SEASON_WEEKDAY, catalog.SEASON_HHMM
        ).collect(),
        "q2_profitable_areas": lambda: profitable_areas(trips(), at).collect(),
        "q2s_profitable_areas_seasonal": lambda: profitable_areas_seasonal(
            trips(), catalog.AREA_WEEKDAY, catalog.AREA_MMDD, catalog.AREA_HHMM
        ).collect(),
        # Same plan over a window with no data (every directory pruned): the
        # fixed cost of planning and scheduling a query, independent of data size.
        "q1_empty_window_overhead": lambda: frequent_routes(trips(), "2099-01-01 00:00").collect(),
        # J7: count(*) of the raw log as CSV and as Parquet (same rows).
        "j7_count_csv": lambda: read_raw_trips(spark, csv_path).count(),
        "j7_count_parquet": lambda: spark.read.parquet(raw_parquet).count(),
        # count(*) of the processed, date-partitioned table (many small files at this size).
        "count_processed_by_date": lambda: read_trips(spark, out_path).count(),
    }
    timings = {}
    for name, fn in queries.items():
        spark.sparkContext.setJobGroup(name, name)
        timings[name] = round(_median_seconds(fn, repeat), 4)
    timings["j1_process"] = round(t_process, 4)
    timings["j1_process_flat"] = round(j1["flat"], 4)
    table_bytes = sum(os.path.getsize(f) for f in glob.glob(f"{out_path}/fecha_*/*/*.parquet"))

    headline = [k for k in timings if k.startswith("q") and not k.endswith("_overhead")]
    total = round(sum(timings[k] for k in headline), 4)
    spark.stop()  # flushes the event log
    try:
        per_group = _bytes_per_group(event_dir)
    except Exception:  # the byte metrics are extra; never lose the timings over them
        per_group = {}
    runs = repeat + 1
    read = {k: v["input"] // runs for k, v in per_group.items() if k.startswith("q")}
    shuffled = {k: v["shuffle"] // runs for k, v in per_group.items() if k.startswith("q")}
    print(
        json.dumps(
            {
                "metric": "q1_q1s_q2_q2s_total_seconds",
                "value": total,
                "unit": "sec",
                "queries": timings,
                "sf": sf,
                "rows_raw": n_raw,
                "rows_clean": n_clean,
                "cpus": cpus,
                "repeat": repeat,
                "rows_per_sec": {
                    **{k: round(n_clean / timings[k]) for k in headline if timings[k] > 0},
                    "j1_process": round(n_raw / t_process) if t_process > 0 else None,
                    "j1_process_flat": round(n_raw / j1["flat"]) if j1["flat"] > 0 else None,
                },
                "processed_table_bytes": table_bytes,
                "input_bytes_per_run": read,
                "shuffle_bytes_per_run": shuffled,
            }
        )
    )


if __name__ == "__main__":
    main()
