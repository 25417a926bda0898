"""Physical-plan checks: pushdown, pruning, no Python evaluation, bounded shuffles."""

from __future__ import annotations

import re

import pytest

from conftest import raw_row, trips_frame
from tripgrid.plans.frequent_routes import frequent_routes, frequent_routes_seasonal
from tripgrid.plans.profitable_areas import profitable_areas, profitable_areas_seasonal
from tripgrid.sources.trips_io import read_trips, write_trips


def _plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rows = [
        raw_row(medallon=f"T{i % 5}", pickup=f"2013-01-{1 + i % 9:02d} 09:{30 + i % 25}:00",
                dropoff=f"2013-01-{1 + i % 9:02d} 09:{40 + i % 19}:00",
                pickup_cell=(150 + i % 3, 155), dropoff_cell=(151 + i % 2, 156 + i % 4))
        for i in range(60)
    ]
    path = str(tmp_path_factory.mktemp("plans") / "trips")
    write_trips(trips_frame(spark, rows), path, layout="by_date")
    return read_trips(spark, path)


QUERIES = {
    "q1": (lambda t: frequent_routes(t, "2013-01-02 10:00"), 1),
    "q1s": (lambda t: frequent_routes_seasonal(t, "enero", "martes", "10:00"), 1),
    "q2": (lambda t: profitable_areas(t, "2013-01-02 10:00"), 2),
    "q2s": (lambda t: profitable_areas_seasonal(t, "martes", "01-08", "10:00"), 2),
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, stored, name):
    build, max_exchanges = QUERIES[name]
    df = build(stored)
    plan = _plan(df)
    assert "PythonEval" not in plan and "ArrowEval" not in plan and "BatchEval" not in plan
    # Exchanges before the top-k: shuffles of the data (the top-k merge is a per-task take).
    assert len(re.findall(r"Exchange hashpartitioning", plan)) <= max_exchanges
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "TakeOrderedAndProject" in plan
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 1
    for scan in scans:
        assert "PartitionFilters: [" in scan and "PartitionFilters: []" not in scan
        assert "PushedFilters: [" in scan and "PushedFilters: []" not in scan
        # Column pruning: no query reads the raw coordinates.
        assert "latitud_subida:decimal" not in scan


def test_q1_reads_only_needed_columns(stored):
    plan = _plan(frequent_routes(stored, "2013-01-02 10:00"))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert set(f.split(":")[0] for f in schema.split(",")) == {
        "hora_subida",
        "hora_bajada",
        "cuad_latitud_subida",
        "cuad_longitud_subida",
        "cuad_latitud_bajada",
        "cuad_longitud_bajada",
    }
