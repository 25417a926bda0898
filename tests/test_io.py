from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import raw_frame, raw_row, trips_frame
from tripgrid import schema as S
from tripgrid.operators.grid import grid_cells
from tripgrid.operators.sample import prefix_sample
from tripgrid.plans.benchmark import performance_summary, run_process, scan_benchmark
from tripgrid.plans.frequent_routes import frequent_routes
from tripgrid.plans.profitable_areas import profitable_areas
from tripgrid.plans.result_line import area_line, route_line
from tripgrid.sources.trips_io import (
    append_timing,
    read_raw_trips,
    read_timings,
    read_trips,
    read_trips_csv,
    register_trips,
    write_result_line,
    write_trips,
    write_trips_csv,
)

SAMPLE = (
    "07290D3599E7A0D62097A346EFCC1FB5,E7750A37CAB07D0DFF0AF7E3573AC141,2013-01-01 00:00:00,"
    "2013-01-01 00:02:00,120,0.44,-73.956528,40.716976,-73.962440,40.715008,CSH,3.50,0.50,0.50,0.00,0.00,4.50"
)


def test_read_raw_csv_sample_and_bad_fields(spark, scratch):
    path = os.path.join(scratch, "raw.csv")
    with open(path, "w") as fh:
        fh.write(SAMPLE + "\n")
        fh.write(",L,2013-01-01 00:00:00,not a time,x,,,,,,CRD,1.00,,,,,\n")
    df = read_raw_trips(spark, path)
    rows = df.collect()
    assert len(rows) == 2
    good, bad = rows
    assert good.hora_subida == dt.datetime(2013, 1, 1, 0, 0) and good.duracion_viaje_seg == 120
    assert str(good.tarifa) == "3.50" and str(good.longitud_subida) == "-73.95652800000000"
    assert bad.medallon is None and bad.hora_bajada is None and bad.duracion_viaje_seg is None
    register_trips(df, "unprocessed_test")
    assert spark.sql("SELECT count(*) FROM unprocessed_test WHERE medallon <> ''").first()[0] == 1


def test_process_job_and_layouts(spark, scratch):
    rows = [
        raw_row(pickup=f"2013-01-0{d} 09:{40 + i}:00", dropoff=f"2013-01-0{d} 09:{50 + i}:00",
                pickup_cell=(150 + i, 155), dropoff_cell=(160, 156 + i))
        for d in range(1, 4)
        for i in range(3)
    ]
    csv = os.path.join(scratch, "raw")
    raw_frame(spark, rows).write.option("timestampNTZFormat", S.TIME_FORMAT).csv(csv)
    out = os.path.join(scratch, "trips")
    timings = os.path.join(scratch, "timings")
    secs = run_process(spark, csv, out, timing_path=timings)
    assert secs > 0
    summary = performance_summary(read_timings(spark, timings)).first()
    assert summary.filas == 9 and summary.velocidad > 0 and summary.eficiencia > 0 and summary.etiqueta == csv
    stored = read_trips(spark, out)
    assert set(S.LAYOUT_COLUMNS) <= set(stored.columns)
    assert stored.count() == 9
    assert os.path.isdir(os.path.join(out, "fecha_subida=2013-01-02", "fecha_bajada=2013-01-02"))
    flat_path = os.path.join(scratch, "flat")
    write_trips(trips_frame(spark, rows), flat_path)
    flat = read_trips(spark, flat_path)
    assert tuple(flat.columns) == S.PROCESSED_COLUMNS
    # Same answers from both layouts.
    for q in (lambda t: frequent_routes(t, "2013-01-02 10:00"), lambda t: profitable_areas(t, "2013-01-02 10:00")):
        assert q(stored).collect() == q(flat).collect()
    with pytest.raises(Exception):
        write_trips(trips_frame(spark, rows), flat_path)  # default mode: error if it exists
    assert read_timings(spark, timings).count() == 1


def test_csv_round_trip(spark, scratch):
    t = trips_frame(spark, [raw_row(), raw_row(medallon="T2", fare="12.34")])
    path = os.path.join(scratch, "csv")
    write_trips_csv(t, path)
    back = read_trips_csv(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, t.collect()))


def test_result_lines(spark, scratch):
    rows = [raw_row(pickup_cell=(150, 155), dropoff_cell=(151, 156)), raw_row(pickup_cell=(152, 157), dropoff_cell=(151, 156))]
    t = trips_frame(spark, rows)
    at = dt.datetime(2013, 1, 1, 10, 0)
    lo = at - dt.timedelta(minutes=30)
    line = route_line(frequent_routes(t, at), "q1", lo, at, elapsed=1.5).first().linea
    assert line == "2013-01-01 09:30:00, 2013-01-01 10:00:00, 0: (150, 155) (151, 156), 1: (152, 157) (151, 156), 1.5"
    a = area_line(profitable_areas(t, at), "q2", lo, at).first().linea
    assert a == "2013-01-01 09:30:00, 2013-01-01 10:00:00, 0: (155, 150) 1: (157, 152) "
    empty = route_line(frequent_routes(t, "2014-01-01 10:00"), "q1", dt.time(9, 30), dt.time(10, 0)).first().linea
    assert empty == "09:30:00, 10:00:00, "
    path = os.path.join(scratch, "lines")
    lines = route_line(frequent_routes(t, at), "q1", lo, at)
    write_result_line(lines, path)
    write_result_line(lines, path)
    assert spark.read.text(path).count() == 2


def test_timing_and_summary(spark, scratch):
    path = os.path.join(scratch, "timings")
    append_timing(spark, path, "q1", 84.82, rows=167_361_464, cores=4, label="full")
    append_timing(spark, path, "q1", 85.18, rows=167_361_464, cores=4, label="full")
    append_timing(spark, path, "q2", 196.63, rows=167_361_464, cores=4, label="full")
    summary = {r.trabajo: r for r in performance_summary(read_timings(spark, path)).collect()}
    assert summary["q1"].ejecuciones == 2
    assert summary["q1"].velocidad == pytest.approx(167_361_464 / 85.0)
    assert summary["q2"].eficiencia == pytest.approx(167_361_464 / 196.63 / 4)


def test_scan_benchmark(spark, scratch):
    csv, twin, timings = (os.path.join(scratch, x) for x in ("csv", "twin", "timings"))
    raw_frame(spark, [raw_row(), raw_row(medallon="x")]).write.option("timestampNTZFormat", S.TIME_FORMAT).csv(csv)
    for _ in range(2):  # the second run finds the twin
        out = {r.formato: r for r in scan_benchmark(spark, csv, twin, timing_path=timings).collect()}
        assert out["csv"].filas == out["parquet"].filas == 2
    summary = performance_summary(read_timings(spark, timings)).collect()
    assert {(r.trabajo, r.ejecuciones) for r in summary} == {("conteo_csv", 2), ("conteo_parquet", 2)}
    assert all(r.velocidad and r.eficiencia for r in summary)


def test_grid_cells(spark):
    g = grid_cells(spark)
    assert g.count() == 90_000
    r = g.where((F.col("X") == 1) & (F.col("Y") == 1)).first()
    assert (r.LATITUD, r.LONGITUD) == (41.477182778, -74.916578)
    last = g.where((F.col("X") == 300) & (F.col("Y") == 300)).first()
    assert last.LATITUD == pytest.approx(41.477182778 - 299 * 0.004491556)
    assert g.select("X", "Y").distinct().count() == 90_000


def test_prefix_sample(spark):
    rows = [
        raw_row(medallon=f"T{i % 13}", licencia=f"L{i}", pickup=f"2013-01-{1 + i % 3:02d} 09:{i % 7:02d}:00",
                dropoff="2013-01-09 10:59:00")
        for i in range(300)
    ] + [raw_row(licencia=f"N{i}", pickup=None) for i in range(5)]
    df = raw_frame(spark, rows)
    order = (S.PICKUP_TIME, S.MEDALLION, S.LICENSE)
    key = lambda r: (r[2] is None, r[2] or 0, r[0], r[1])
    ordered = sorted(rows, key=key)
    for n in (0, 1, 14, 15, 137, 299, 300, 303, 305, 1000):
        got = prefix_sample(df, n, order).collect()
        assert sorted(((r[0], r[1], r[2]) for r in got), key=lambda r: (r[2] is None, r[2] or 0, r)) == [
            (r[0], r[1], r[2]) for r in ordered[:n]
        ], n
    assert prefix_sample(df.limit(0), 5, order).count() == 0


def test_ladder_summary(spark):
    from tripgrid.operators.sample import ladder_summary, size_ladder

    rows = [raw_row(licencia=f"L{i}", pickup=f"2013-01-01 09:{i // 9:02d}:00") for i in range(100)]
    rows += [raw_row(licencia=f"N{i}", pickup=None) for i in range(4)]
    df = raw_frame(spark, rows)
    sizes = [0, 1, 9, 10, 95, 102, 104]
    out = {r.tamano: r for r in ladder_summary(df, (S.PICKUP_TIME, S.LICENSE), sizes=sizes).collect()}
    for n in sizes:
        assert out[n].filas == n
        assert out[n].max_subida == max((r[2] for r in rows[:n] if r[2]), default=None)
    assert [(n, p.count()) for n, p in size_ladder(df, (S.PICKUP_TIME, S.LICENSE), sizes=sizes)] == [(n, n) for n in sizes]


def test_legacy_ltz_table_gives_same_answers(spark, scratch):
    """Processed tables written by the original program store zone-aware TIMESTAMPs."""
    from tripgrid.plans.frequent_routes import frequent_routes_seasonal
    from tripgrid.plans.profitable_areas import profitable_areas_seasonal

    rows = [
        raw_row(medallon=f"T{i % 5}", pickup=f"2013-01-{1 + 7 * (i % 3):02d} 09:{30 + i % 25}:00",
                dropoff=f"2013-01-{1 + 7 * (i % 3):02d} 09:{40 + i % 19}:00",
                pickup_cell=(150 + i % 3, 155), dropoff_cell=(151 + i % 2, 156 + i % 4))
        for i in range(50)
    ]
    ntz = trips_frame(spark, rows)
    path = os.path.join(scratch, "legacy")
    ntz.withColumns({c: F.col(c).cast("timestamp") for c in (S.PICKUP_TIME, S.DROPOFF_TIME)}).write.parquet(path)
    ltz = read_trips(spark, path)
    assert dict(ltz.dtypes)[S.PICKUP_TIME] == "timestamp"
    for q in (
        lambda t: frequent_routes(t, "2013-01-08 10:00"),
        lambda t: frequent_routes_seasonal(t, "enero", "martes", "10:00"),
        lambda t: profitable_areas(t, "2013-01-08 10:00"),
        lambda t: profitable_areas_seasonal(t, "martes", "01-08", "10:00"),
    ):
        assert q(ltz).collect() == q(ntz).collect()


def test_catalog_table_layout(spark, scratch):
    from tripgrid.sources.trips_io import read_trips_table

    rows = [raw_row(pickup=f"2013-01-0{d} 09:45:00", dropoff=f"2013-01-0{d} 09:55:00") for d in range(1, 4)]
    t = trips_frame(spark, rows)
    write_trips(t, os.path.join(scratch, "tbl"), layout="by_date", table="trips_catalog_test")
    back = read_trips_table(spark, "trips_catalog_test")
    assert back.count() == 3
    q = frequent_routes(back, "2013-01-02 10:00")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan
    assert q.collect() == frequent_routes(t, "2013-01-02 10:00").collect()
    spark.sql("DROP TABLE trips_catalog_test")


def test_size_ladder(spark, scratch):
    from tripgrid.operators.sample import ladder_sizes, write_size_ladder

    assert ladder_sizes(173_185_091)[:4] == [173_185, 346_370, 3_463_701, 17_318_509]
    rows = [raw_row(licencia=f"L{i}", pickup=f"2013-01-{1 + i % 20:02d} 09:{i % 60:02d}:00",
                    dropoff=f"2013-01-{1 + i % 20:02d} 10:{i % 60:02d}:00") for i in range(200)]
    df = raw_frame(spark, rows)
    out = write_size_ladder(df, os.path.join(scratch, "ladder"), (S.PICKUP_TIME, S.LICENSE),
                            fractions=((1, 10), (1, 2), (1, 1)), fmt="parquet")
    assert [n for n, _ in out] == [20, 100, 200]
    first = spark.read.parquet(out[0][1])
    expected = sorted(rows, key=lambda r: (r[2], r[1]))[:20]
    assert sorted(r.licencia for r in first.collect()) == sorted(r[1] for r in expected)


def test_size_ladder_csv_reads_back_as_raw_log(spark, scratch):
    from tripgrid.operators.sample import write_size_ladder

    rows = [raw_row(licencia=f"L{i}", pickup=f"2013-01-02 09:{i:02d}:00", dropoff=f"2013-01-02 10:{i:02d}:00")
            for i in range(40)]
    out = write_size_ladder(raw_frame(spark, rows), os.path.join(scratch, "ladder_csv"), (S.PICKUP_TIME, S.LICENSE),
                            fractions=((1, 4), (1, 1)))
    back = read_raw_trips(spark, out[0][1])
    assert back.count() == 10 and back.where(F.col(S.PICKUP_TIME).isNull()).count() == 0


def test_scratch_is_one_folder_per_application(spark):
    from tripgrid.session import clear_scratch, scratch_path

    one, other = scratch_path(spark, "a"), scratch_path(spark, "a")
    assert one != other and spark.sparkContext.applicationId in one
    spark.range(3).write.parquet(one)
    assert spark.read.parquet(one).count() == 3
    clear_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(one)
    clear_scratch(spark)  # nothing left: no error
