"""The file index, what it lets a query open, and compaction."""

from __future__ import annotations

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import raw_frame, raw_row, trips_frame
from tripgrid import schema as S
from tripgrid.operators.clean import process_trips
from tripgrid.plans.frequent_routes import frequent_routes, frequent_routes_seasonal
from tripgrid.plans.profitable_areas import profitable_areas, profitable_areas_seasonal
from tripgrid.sources.trip_store import INDEX_FOLDER, TripStore, compact_trips, in_window_sql, index_trips, vacuum
from tripgrid.sources.trips_io import open_trips, read_trips, write_trips
from tripgrid.streaming.process_stream import process_stream

TIE = (S.LICENSE,)
QUERIES = (
    lambda t: frequent_routes(t, "2013-01-08 10:00"),
    lambda t: frequent_routes(t, "2013-01-09 00:10"),
    lambda t: frequent_routes(t, "2014-05-05 10:00"),
    lambda t: frequent_routes_seasonal(t, "enero", "martes", "10:00"),
    lambda t: frequent_routes_seasonal(t, "enero", "martes", "00:15"),
    lambda t: frequent_routes_seasonal(t, "enero", "martes", "10:00", compat=True),
    lambda t: profitable_areas(t, "2013-01-08 10:00", tiebreak=TIE),
    lambda t: profitable_areas(t, "2013-01-08 10:00", taxi_minutes=10, benefit_minutes=40),
    lambda t: profitable_areas_seasonal(t, "martes", "01-08", "10:00", tiebreak=TIE),
    lambda t: profitable_areas_seasonal(t, "martes", "01-08", "00:15", tiebreak=TIE),
    lambda t: profitable_areas_seasonal(t, "martes", "01-08", "10:00", compat=True, tiebreak=TIE),
    lambda t: profitable_areas_seasonal(t, "martes", "01-08", "00:15", compat=True, tiebreak=TIE),
    lambda t: profitable_areas_seasonal(t, "martes", "01-08", "10:00", taxi_minutes=10, benefit_minutes=40),
)


def made(n=1500, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        start = dt.datetime(2013, 1, rng.randint(1, 20)) + dt.timedelta(minutes=rng.choice([rng.randint(0, 1439), rng.randint(560, 600), rng.randint(1420, 1439), rng.randint(0, 15)]))
        end = start + dt.timedelta(seconds=rng.randint(1, 2400))
        rows.append(raw_row(medallon=f"T{rng.randint(0, 30)}", licencia=f"L{i}", pickup=start, dropoff=end,
                            pickup_cell=(150 + rng.randint(0, 2), 155), dropoff_cell=(153 + rng.randint(0, 1), 156 + rng.randint(0, 1)), fare=f"{rng.randint(1, 40)}.00"))
    return rows


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    trips = trips_frame(spark, made())
    path = str(tmp_path_factory.mktemp("store") / "a table")
    write_trips(trips.repartition(4), path, layout="by_date", rows_per_file=40)
    return trips, path


def keys(df):
    return sorted(r[0] for r in df.select(S.LICENSE).collect())


def test_index_names_every_file_with_its_bounds(spark, table):
    trips, path = table
    store = open_trips(spark, path)
    assert isinstance(store, TripStore) and store.generation == 1
    files = store.files().collect()
    assert {r.archivo for r in files} == {os.path.relpath(f, path) for f in glob.glob(f"{path}/fecha_*/*/*.parquet")}
    for r in files:
        rows = spark.read.parquet(f"{path}/{r.archivo}").agg(F.count(F.lit(1)), F.min(S.PICKUP_TIME), F.max(S.PICKUP_TIME), F.min(S.DROPOFF_TIME), F.max(S.DROPOFF_TIME)).first()
        assert tuple(rows) == (r.filas, r.min_hora_subida, r.max_hora_subida, r.min_hora_bajada, r.max_hora_bajada)
        assert r.bytes == os.path.getsize(f"{path}/{r.archivo}")
    assert store.frame().schema == read_trips(spark, path).schema
    assert keys(store.frame()) == keys(trips)


def test_queries_through_the_index(spark, table):
    trips, path = table
    store = open_trips(spark, path)
    for query in QUERIES:
        assert query(store).collect() == query(trips).collect()
    lo, hi = dt.datetime(2013, 1, 8, 9, 30), dt.datetime(2013, 1, 8, 10)
    opened = frequent_routes(store, hi).inputFiles()
    assert 0 < len(opened) <= 4 < store.files().count() / 5
    assert {f.split("/")[-1] for f in opened} <= {r.archivo.split("/")[-1] for r in store.files(in_window_sql(S.PICKUP_TIME, lo, hi)).collect()}
    assert store.frame("false").columns == store.frame().columns and store.frame("false").count() == 0


def test_flat_and_legacy_tables(spark, scratch):
    trips = trips_frame(spark, made(200))
    path = os.path.join(scratch, "flat")
    write_trips(trips, path)
    assert not isinstance(open_trips(spark, path), TripStore)
    index_trips(spark, path)
    assert keys(open_trips(spark, path).frame()) == keys(trips)
    legacy = os.path.join(scratch, "legacy")
    trips.withColumns({c: F.col(c).cast("timestamp") for c in (S.PICKUP_TIME, S.DROPOFF_TIME)}).write.parquet(legacy)
    store = index_trips(spark, legacy)
    for query in QUERIES[:9]:
        assert query(store).collect() == query(trips).collect()


def test_empty_table(spark, scratch):
    path = os.path.join(scratch, "none")
    write_trips(trips_frame(spark, made(5)).where("false"), path, layout="by_date")
    store = open_trips(spark, path)
    assert store.frame().count() == 0 and frequent_routes(store, "2013-01-08 10:00").count() == 0


def test_appends_unfinished_generations_and_stray_files(spark, scratch):
    rows, path = made(300), os.path.join(scratch, "parts")
    write_trips(trips_frame(spark, rows[:100]), path, layout="by_date")
    first = open_trips(spark, path)
    write_trips(trips_frame(spark, rows[100:]), path, mode="append", layout="by_date")
    assert open_trips(spark, path).generation == 2
    assert keys(first.frame()) == sorted(r[1] for r in rows[:100])  # a reader keeps its generation
    assert keys(open_trips(spark, path).frame()) == sorted(r[1] for r in rows)
    # A job that died while it wrote the index, and one that died before.
    os.makedirs(f"{path}/{INDEX_FOLDER}/v=3")
    stray = glob.glob(f"{path}/fecha_*/*/*.parquet")[0]
    with open(stray, "rb") as source, open(os.path.join(os.path.dirname(stray), "part-99999-stray.parquet"), "wb") as copy:
        copy.write(source.read())
    assert open_trips(spark, path).generation == 2
    assert keys(open_trips(spark, path).frame()) == sorted(r[1] for r in rows)
    with pytest.raises(Exception, match="exists already"):
        write_trips(trips_frame(spark, rows[:2]), path, layout="by_date")


def test_compaction_of_a_stream_s_small_files(spark, scratch):
    rows = made(400, 5)
    raw_dir, out = os.path.join(scratch, "raw"), os.path.join(scratch, "trips")
    raw_frame(spark, rows).repartition(6).write.option("timestampNTZFormat", S.TIME_FORMAT).csv(raw_dir)
    process_stream(spark, raw_dir, out, max_files_per_trigger=1).awaitTermination(180)
    want = sorted(r[1] for r in rows)
    before = index_trips(spark, out)
    n_before = before.files().count()
    after = compact_trips(spark, out, rows_per_file=1000)
    assert keys(before.frame()) == want == keys(after.frame())  # old readers go on, new ones see each row once
    files = after.files().collect()
    assert len(files) < n_before / 2 and sum(r.filas for r in files) == len(want)
    for r in files:
        times = [x[0] for x in spark.read.parquet(f"{out}/{r.archivo}").select(S.PICKUP_TIME).collect()]
        assert times == sorted(times)
    for query in QUERIES[:9]:
        assert query(after).collect() == query(before).collect()
    # More of the stream: only the new files are added; nothing is left to merge twice.
    raw_frame(spark, [raw_row(licencia="NEW", pickup="2013-01-08 09:45:00", dropoff="2013-01-08 09:55:00")]).write.mode("append").option("timestampNTZFormat", S.TIME_FORMAT).csv(raw_dir)
    process_stream(spark, raw_dir, out).awaitTermination(180)
    assert keys(index_trips(spark, out).frame()) == sorted([*want, "NEW"])
    deleted = vacuum(spark, out)
    assert deleted > 0 and keys(open_trips(spark, out).frame()) == sorted([*want, "NEW"])
    assert compact_trips(spark, out, rows_per_file=1000).generation >= after.generation


def test_compaction_that_dies_leaves_the_table_as_it_was(spark, scratch, monkeypatch):
    from tripgrid.sources import trip_store

    rows, path = made(200, 6), os.path.join(scratch, "dies")
    for part in range(4):
        write_trips(trips_frame(spark, rows[part::4]), path, mode="append", layout="by_date")

    def dies(*args):
        raise RuntimeError("lost")

    whole = trip_store._write_generation
    monkeypatch.setattr(trip_store, "_write_generation", dies)
    with pytest.raises(RuntimeError):
        compact_trips(spark, path)
    monkeypatch.setattr(trip_store, "_write_generation", whole)
    assert keys(index_trips(spark, path).frame()) == sorted(r[1] for r in rows)  # its files are not taken for a load's
    assert keys(compact_trips(spark, path).frame()) == sorted(r[1] for r in rows)


def test_process_trips_is_what_a_store_holds(spark, table):
    trips, path = table
    assert sorted(map(str, open_trips(spark, path).frame().select(*S.PROCESSED_COLUMNS).collect())) == sorted(map(str, process_trips(raw_frame(spark, made())).collect()))
