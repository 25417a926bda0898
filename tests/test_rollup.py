"""Seasonal routes from the rollup equal those from the trips."""

from __future__ import annotations

import datetime as dt
import os

import pytest

from conftest import trips_frame
from test_trip_store import made
from tripgrid.plans.frequent_routes import frequent_routes_seasonal
from tripgrid.plans.seasonal_rollup import band_slots, frequent_routes_seasonal_from_rollup, read_route_rollup, route_rollup, write_route_rollup
from tripgrid.sources import trip_store
from tripgrid.sources.trips_io import open_trips, write_trips


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    trips = trips_frame(spark, made(2500, 9))
    folder = tmp_path_factory.mktemp("rollup")
    write_trips(trips, str(folder / "trips"), layout="by_date", rows_per_file=60)
    write_route_rollup(trips, str(folder / "rollup"))
    return trips, open_trips(spark, str(folder / "trips")), read_route_rollup(spark, str(folder / "rollup"))


def test_slots_of_bands():
    slots = band_slots(dt.time(9, 30), dt.time(10, 0))
    assert slots.whole == [38, 39] and slots.cut == [(dt.time(10, 0), dt.time(10, 0))]
    slots = band_slots(dt.time(9, 20), dt.time(9, 50, 30))
    assert slots.whole == [38] and slots.cut == [(dt.time(9, 20), dt.time(9, 29, 59, 999999)), (dt.time(9, 45), dt.time(9, 50, 30))]
    slots = band_slots(dt.time(23, 45), dt.time(0, 15))
    assert sorted(slots.whole) == [0, 95] and slots.cut == [(dt.time(0, 15), dt.time(0, 15))]
    assert band_slots(dt.time(9, 1), dt.time(9, 2)).whole == []


@pytest.mark.parametrize("hhmm,minutes", [("10:00", 30), ("09:50", 30), ("10:07", 5), ("00:15", 30), ("00:00", 30), ("00:10", 45), ("23:59:59", 60), ("10:00", 0)])
def test_equals_the_query_over_trips(stored, hhmm, minutes):
    trips, log, rollup = stored
    # The near period's borders fall among the trips.
    for weekday, near_days in (("martes", 9.0), ("viernes", 30), ("domingo", 12.4)):
        want = frequent_routes_seasonal(trips, "enero", weekday, hhmm, minutes=minutes, near_days=near_days).collect()
        for source in (trips, log):
            got = frequent_routes_seasonal_from_rollup(rollup, source, "enero", weekday, hhmm, minutes=minutes, near_days=near_days)
            assert got.collect() == want


def test_most_trips_come_from_the_rollup(spark, stored):
    trips, log, rollup = stored
    assert rollup.agg({"viajes": "sum"}).first()[0] == trips.count() == route_rollup(log.frame()).agg({"viajes": "sum"}).first()[0]
    opened = [f for f in frequent_routes_seasonal_from_rollup(rollup, log, "enero", "martes", "10:00").inputFiles() if os.sep + "trips" + os.sep in f]
    whole = frequent_routes_seasonal(log, "enero", "martes", "10:00").inputFiles()
    assert len(opened) <= len(whole)


def test_looking_up_many_files_takes_few_tasks(spark, stored, monkeypatch):
    _, log, _ = stored
    files = log.files().count()
    monkeypatch.setattr(trip_store, "_LISTED_BY_DRIVER", 0)
    monkeypatch.setattr(trip_store, "_LISTING_TASKS_PER_CORE", 1)
    tasks = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(tasks)
    context = spark.sparkContext
    context.setJobGroup("lookup", "files of a store")
    try:
        read = log.frame()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("lookup") for s in tracker.getJobInfo(j).stageIds]
    most = max(s.numTasks for s in stages if s)
    assert files > context.defaultParallelism >= most
    assert len(read.inputFiles()) == files and spark.conf.get(tasks) == before
