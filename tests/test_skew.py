"""One date, one taxi and one route holding most of the rows."""

from __future__ import annotations

import glob
import os

from conftest import raw_row, trips_frame
from tripgrid.plans.frequent_routes import frequent_routes, frequent_routes_seasonal
from tripgrid.plans.profitable_areas import profitable_areas, profitable_areas_seasonal
from tripgrid.sources.trips_io import read_trips, write_trips


def _skewed_rows():
    rows = []
    # Hot: 600 trips of one taxi on one route on 2013-01-08.
    for i in range(600):
        rows.append(raw_row(medallon="HOT", licencia=f"L{i}", pickup=f"2013-01-08 09:{30 + i % 20}:{i % 60:02d}",
                            dropoff=f"2013-01-08 09:{40 + i % 19}:{i % 60:02d}"))
    # Background: 400 trips spread over other dates, taxis and routes.
    for i in range(400):
        day = 1 + (i % 28)
        rows.append(raw_row(medallon=f"T{i % 37}", licencia=f"B{i}", pickup=f"2013-01-{day:02d} 09:{30 + i % 25}:00",
                            dropoff=f"2013-01-{day:02d} 09:{45 + i % 14}:00",
                            pickup_cell=(150 + i % 4, 155 + i % 3), dropoff_cell=(160 + i % 2, 150 + i % 5)))
    return rows


def test_hot_date_is_split_and_answers_match(spark, scratch):
    trips = trips_frame(spark, _skewed_rows()).repartition(8)
    path = os.path.join(scratch, "skewed")
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        write_trips(trips, path, layout="by_date")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot_files = glob.glob(os.path.join(path, "fecha_subida=2013-01-08", "fecha_bajada=2013-01-08", "*.parquet"))
    assert len(hot_files) > 1, "adaptive rebalance should split the hot date over several tasks"
    stored = read_trips(spark, path)
    flat = trips_frame(spark, _skewed_rows())
    for q in (
        lambda t: frequent_routes(t, "2013-01-08 10:00"),
        lambda t: frequent_routes_seasonal(t, "enero", "martes", "10:00"),
        lambda t: profitable_areas(t, "2013-01-08 10:00", tiebreak=("licencia",)),
        lambda t: profitable_areas_seasonal(t, "martes", "01-08", "10:00", tiebreak=("licencia",)),
    ):
        assert q(stored).collect() == q(flat).collect()
    top = frequent_routes(stored, "2013-01-08 10:00").first()
    assert top.viajes > 300


def test_same_answers_without_aqe_and_other_shuffle_width(spark):
    trips = trips_frame(spark, _skewed_rows())
    queries = (
        lambda t: frequent_routes(t, "2013-01-08 10:00"),
        lambda t: frequent_routes_seasonal(t, "enero", "martes", "10:00"),
        lambda t: profitable_areas(t, "2013-01-08 10:00", tiebreak=("licencia",)),
        lambda t: profitable_areas_seasonal(t, "martes", "01-08", "10:00", tiebreak=("licencia",)),
    )
    baseline = [q(trips).collect() for q in queries]
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "23")
        assert [q(trips).collect() for q in queries] == baseline
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_busy_date_is_cut_by_the_time_of_day_and_small_dates_stay_whole(spark, scratch):
    """With default options a half-hour band opens few files of a busy date."""
    from tripgrid.sources.trip_store import TripStore, in_band_sql

    from tripgrid import schema as S

    rows = [
        raw_row(licencia=f"L{i}", pickup=f"2013-01-08 {i % 24:02d}:{(i // 24) % 60:02d}:00",
                dropoff=f"2013-01-08 {i % 24:02d}:{(i // 24) % 60:02d}:30")
        for i in range(24 * 60 * 4)
    ]
    small = [raw_row(licencia=f"S{d}-{i}", pickup=f"2013-02-{d:02d} {i:02d}:10:00", dropoff=f"2013-02-{d:02d} {i:02d}:20:00") for d in range(1, 29) for i in range(24)]
    path = os.path.join(scratch, "busy")
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(160 * 100))  # about 100 rows a file
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        write_trips(trips_frame(spark, rows + small).repartition(8), path, layout="by_date")
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)
    store = TripStore(spark, path)
    busy = "to_date(min_hora_subida) = DATE '2013-01-08'"
    n_busy = store.files(busy).count()
    assert n_busy >= 40
    assert 1 <= store.files(f"{busy} AND {in_band_sql(S.PICKUP_TIME, '09:05', '09:35')}").count() <= n_busy / 10
    per_date = store.files(f"NOT ({busy})").groupBy("min_hora_subida").count()
    assert per_date.count() == 28 and per_date.agg({"count": "max"}).first()[0] == 1
    hours = spark.read.parquet(path).where("fecha_subida = DATE '2013-01-08'").count()
    assert hours == len(rows)
