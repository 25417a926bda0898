from __future__ import annotations

from pyspark.sql import functions as F

from conftest import raw_row, trips_frame
from tripgrid.plans.profitable_areas import profitable_areas_seasonal
from tripgrid import schema as S
from tripgrid.operators.routes import route_counts
from tripgrid.operators.topk import top_k
from tripgrid.plans.frequent_routes import frequent_routes, frequent_routes_seasonal, routes_in_window


def test_q1_window_closed_on_both_ends(spark):
    rows = [
        raw_row(pickup="2013-01-01 09:30:00", dropoff="2013-01-01 10:00:00"),  # both edges: in
        raw_row(pickup="2013-01-01 09:29:59", dropoff="2013-01-01 09:45:00"),  # starts before: out
        raw_row(pickup="2013-01-01 09:45:00", dropoff="2013-01-01 10:00:01"),  # ends after: out
        raw_row(pickup="2013-01-01 09:50:00", dropoff="2013-01-01 09:55:00", dropoff_cell=(152, 157)),
    ]
    out = frequent_routes(trips_frame(spark, rows), "2013-01-01 10:00").collect()
    assert [(r["rank"], r.cuad_longitud_bajada, r.viajes) for r in out] == [(0, 151, 1), (1, 152, 1)]


def test_q1_ties_broken_by_keys_and_rank_limit(spark):
    rows = []
    for x in range(12):  # 12 routes with one trip each, one route with two
        rows.append(raw_row(pickup_cell=(100 + x, 100), dropoff_cell=(200, 200)))
    rows.append(raw_row(pickup_cell=(111, 100), dropoff_cell=(200, 200)))
    out = frequent_routes(trips_frame(spark, rows), "2013-01-01 10:00").collect()
    assert len(out) == 10
    assert [r["rank"] for r in out] == list(range(10))
    assert (out[0].cuad_longitud_subida, out[0].viajes) == (111, 2)
    assert [r.cuad_longitud_subida for r in out[1:]] == list(range(100, 109))


def test_route_counts_sum_equals_rows_in_window(spark):
    rows = [raw_row(pickup_cell=(150 + i % 3, 155), dropoff_cell=(160, 150 + i % 2)) for i in range(20)]
    t = trips_frame(spark, rows)
    w = routes_in_window(t, "2013-01-01 10:00")
    assert route_counts(w).agg(F.sum("viajes")).first()[0] == w.count() == 20


def test_top_k_nulls_last(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, 7.0)], "key int, m double")
    out = top_k(df, "m", ["key"], k=3).collect()
    assert [(r["rank"], r.key) for r in out] == [(0, 3), (1, 2), (2, 1)]


def test_q1s_weights_band_and_compat(spark):
    # Reference instant: 2013-01-01 10:00 (first of January); weekday Tuesday; band 09:30-10:00.
    rows = [
        raw_row(medallon="a", pickup="2013-01-08 09:35:00", dropoff="2013-01-08 09:55:00"),  # near: 2
        raw_row(medallon="b", pickup="2013-03-05 09:35:00", dropoff="2013-03-05 09:55:00"),  # far: 1
        raw_row(medallon="c", pickup="2013-01-08 09:35:00", dropoff="2013-01-08 10:05:00"),  # drop-off outside band
        raw_row(medallon="d", pickup="2013-01-09 09:35:00", dropoff="2013-01-09 09:55:00"),  # Wednesday
    ]
    t = trips_frame(spark, rows)
    out = frequent_routes_seasonal(t, "enero", "martes", "10:00").collect()
    assert [(r.frecuencia) for r in out] == [3]
    compat = frequent_routes_seasonal(t, "enero", "martes", "10:00", compat=True).collect()
    assert [(r.frecuencia) for r in compat] == [5]  # band flags ignored: a, b, c


def test_q1s_band_across_midnight(spark):
    rows = [
        raw_row(pickup="2013-01-07 23:50:00", dropoff="2013-01-07 23:58:00"),
        raw_row(pickup="2013-01-08 00:01:00", dropoff="2013-01-08 00:09:00"),
        raw_row(pickup="2013-01-08 00:11:00", dropoff="2013-01-08 00:14:00"),
    ]
    out = frequent_routes_seasonal(trips_frame(spark, rows), "enero", "martes", "00:10").collect()
    assert [r.frecuencia for r in out] == [4]


def test_partition_invariance(spark):
    rows = [raw_row(pickup_cell=(150 + i % 4, 155 + i % 3), dropoff_cell=(160, 150 + i % 5)) for i in range(60)]
    t = trips_frame(spark, rows)
    a = frequent_routes(t, "2013-01-01 10:00").collect()
    b = frequent_routes(t.repartition(7, S.MEDALLION), "2013-01-01 10:00").collect()
    assert a == b


def test_seasonal_band_across_midnight_belongs_to_the_day_it_ends(spark):
    rows = [
        raw_row(pickup="2013-03-04 23:50:00", dropoff="2013-03-05 00:05:00", pickup_cell=(10, 11)),  # Monday to Tuesday
        raw_row(pickup="2013-03-05 23:50:00", dropoff="2013-03-06 00:05:00", pickup_cell=(12, 13)),  # Tuesday to Wednesday
        raw_row(pickup="2013-03-05 00:01:00", dropoff="2013-03-05 00:10:00", pickup_cell=(14, 15)),
    ]
    trips = trips_frame(spark, rows)
    got = frequent_routes_seasonal(trips, "marzo", "martes", "00:15").collect()
    assert {(r.cuad_longitud_subida, r.cuad_latitud_subida) for r in got} == {(10, 11), (14, 15)}
    areas = profitable_areas_seasonal(trips, "martes", "03-05", "00:15").collect()
    assert {(r.cuad_longitud, r.cuad_latitud) for r in areas} == {(10, 11), (14, 15)}
