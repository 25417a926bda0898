"""Write PLANS.md: formatted physical plans of the four queries over the by_date layout.

Usage: python scripts/show_plans.py [sf_dir] [out.md]
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripgrid import catalog  # noqa: E402
from tripgrid.plans.frequent_routes import frequent_routes, frequent_routes_seasonal  # noqa: E402
from tripgrid.plans.profitable_areas import profitable_areas, profitable_areas_seasonal  # noqa: E402
from tripgrid.session import local_session  # noqa: E402
from tripgrid.operators.clean import process_trips  # noqa: E402
from tripgrid.sources.trips_io import layout_frame, open_trips, read_raw_trips, write_trips  # noqa: E402


def formatted(df) -> str:
    jvm = df.sparkSession.sparkContext._jvm
    text = jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    # Drop expression ids and local paths so the file is stable between runs.
    text = re.sub(r"#\d+L?", "", text)
    return re.sub(r"file:/\S+", "<table>", text)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else "PLANS.md"
    spark = local_session(8, 8)
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    path = tempfile.mkdtemp(prefix="tripgrid-plans-") + "/trips"
    write_trips(catalog.trips(spark, sf_dir), path, layout="by_date")
    trips = open_trips(spark, path)
    raw_csv = tempfile.mkdtemp(prefix="tripgrid-plans-") + "/raw"
    catalog.raw_trips(spark, sf_dir).drop("k").write.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(raw_csv)
    queries = [
        (
            "J1 clean + enrich, as handed to the by_date writer",
            layout_frame(process_trips(read_raw_trips(spark, raw_csv)), "by_date"),
        ),
        ("Q1 frequent routes at 2013-03-19 10:00", frequent_routes(trips, catalog.AT)),
        (
            "Q1S seasonal routes (January, Tuesday, 10:00)",
            frequent_routes_seasonal(trips, catalog.SEASON_MONTH, catalog.SEASON_WEEKDAY, catalog.SEASON_HHMM),
        ),
        ("Q2 profitable areas at 2013-03-19 10:00", profitable_areas(trips, catalog.AT)),
        (
            "Q2S seasonal areas (Tuesday, 03-19, 10:00)",
            profitable_areas_seasonal(trips, catalog.AREA_WEEKDAY, catalog.AREA_MMDD, catalog.AREA_HHMM),
        ),
    ]
    parts = [
        "# Physical plans",
        "",
        "Generated by `scripts/show_plans.py` over the processed trips of "
        f"`{sf_dir}` stored with `write_trips(layout=\"by_date\")` (AQE on; the final adaptive plan "
        "may coalesce partitions further). The four queries are shown after running them (final "
        "adaptive plan, with `[codegen id : N]` marking whole-stage codegen); J1 before writing. "
        "J1 reads the raw CSV log. Look for `PartitionFilters`, "
        "`PushedFilters`, `ReadSchema`, the `Exchange` count and `TakeOrderedAndProject`.",
        "",
    ]
    for title, df in queries:
        if title.startswith("Q"):
            df.collect()  # at most 10 rows; the final adaptive plan then shows its codegen stages
        parts += [f"## {title}", "", "```", formatted(df).strip(), "```", ""]
    with open(out, "w") as fh:
        fh.write("\n".join(parts))
    print(f"wrote {out}")


if __name__ == "__main__":
    main()
