"""The four queries over a table of many copies of the raw log.

Usage: python scripts/scale_benchmark.py <sf_dir> <copies> <folder> [repeat]

Every copy shifts the rows' keys, so times, taxis and cells differ from copy to
copy. The table is written once, into a new folder, in the default layout; an
existing one is used as it is. Prints one JSON line with the rows, the seconds
of the load, and each query's median seconds, files opened and bytes of them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tripgrid import catalog  # noqa: E402
from tripgrid.operators.clean import process_trips  # noqa: E402
from tripgrid.plans.frequent_routes import frequent_routes, frequent_routes_seasonal  # noqa: E402
from tripgrid.plans.profitable_areas import profitable_areas, profitable_areas_seasonal  # noqa: E402
from tripgrid.session import clear_scratch, local_session  # noqa: E402
from tripgrid.sources.fixture import raw_trips_from_lineitem, read_lineitem  # noqa: E402
from tripgrid.sources.trips_io import open_trips, write_trips  # noqa: E402

KEY_STEP = 1_500_007


def main() -> None:
    sf_dir, copies, folder = sys.argv[1], int(sys.argv[2]), sys.argv[3]
    repeat = int(sys.argv[4]) if len(sys.argv) > 4 else 3
    os.makedirs(folder, exist_ok=True)
    spark = local_session("*", shuffle_partitions=32, checkpoint_dir=f"{folder}/checkpoints")
    path, load = f"{folder}/trips", None
    if not os.path.exists(path):
        lineitem = read_lineitem(spark, sf_dir).repartition(32).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        shifted = lineitem.withColumn("l_orderkey", F.col("l_orderkey") + F.col("copy") * KEY_STEP)
        start = time.perf_counter()
        write_trips(process_trips(raw_trips_from_lineitem(shifted)), path, layout="by_date")
        load = round(time.perf_counter() - start, 2)
        clear_scratch(spark)
    queries = {
        "q1": lambda t: frequent_routes(t, catalog.AT),
        "q1s": lambda t: frequent_routes_seasonal(t, catalog.SEASON_MONTH, catalog.SEASON_WEEKDAY, catalog.SEASON_HHMM),
        "q2": lambda t: profitable_areas(t, catalog.AT),
        "q2s": lambda t: profitable_areas_seasonal(t, catalog.AREA_WEEKDAY, catalog.AREA_MMDD, catalog.AREA_HHMM),
        "q1_empty": lambda t: frequent_routes(t, "2099-01-01 00:00"),
    }
    out = {}
    for name, query in queries.items():
        times = []
        for _ in range(repeat + 1):
            start = time.perf_counter()
            query(open_trips(spark, path)).collect()
            times.append(time.perf_counter() - start)
        opened = query(open_trips(spark, path)).inputFiles()
        out[name] = {"seconds": round(statistics.median(times[1:]), 3), "files": len(opened)}
    files = open_trips(spark, path).files().agg(F.count(F.lit(1)), F.sum("filas"), F.sum("bytes")).first()
    print(json.dumps({"files": files[0], "rows": files[1], "bytes": files[2], "load_seconds": load, "queries": out}))
    spark.stop()


if __name__ == "__main__":
    main()
