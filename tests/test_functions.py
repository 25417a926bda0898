from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import lat_of, lon_of, ts
from tripgrid.functions import (
    band_before,
    band_occurrence_date,
    cell_corner_lat,
    cell_corner_lon,
    in_time_of_day,
    lat_cell,
    lon_cell,
    month_number,
    near_weight,
    tier_weight,
    weekday0,
    weekday_number,
)
from tripgrid.functions.weights import COMPAT_TIERS


def test_cells_of_cell_centres(spark):
    rows = [(lon_of(x), lat_of(y), x, y) for x, y in [(1, 1), (150, 155), (300, 300), (17, 283)]]
    df = spark.createDataFrame(rows, "lon decimal(18,14), lat decimal(18,14), x int, y int")
    out = df.select(lon_cell("lon").alias("cx"), lat_cell("lat").alias("cy"), "x", "y").collect()
    assert all(r.cx == r.x and r.cy == r.y for r in out)


@settings(max_examples=25, deadline=None)
@given(st.integers(1, 300), st.integers(1, 300))
def test_corner_round_trip(spark, x, y):
    """The NW corner of a cell, nudged inside the cell, maps back to the same cell."""
    df = spark.range(1).select(cell_corner_lon(F.lit(x)).alias("lon"), cell_corner_lat(F.lit(y)).alias("lat"))
    r = df.select(
        lon_cell(F.col("lon") + F.lit(1e-6)).alias("cx"), lat_cell(F.col("lat") - F.lit(1e-6)).alias("cy")
    ).first()
    assert (r.cx, r.cy) == (x, y)


def test_far_edge_cells(spark):
    """Exactly on the far box edge: latitude gives 300, longitude gives 301 in double arithmetic."""
    df = spark.createDataFrame([("-73.120778", "40.129715978")], "lon string, lat string").select(
        F.col("lon").cast("decimal(18,14)").alias("lon"), F.col("lat").cast("decimal(18,14)").alias("lat")
    )
    r = df.select(lon_cell("lon").alias("cx"), lat_cell("lat").alias("cy")).first()
    assert (r.cx, r.cy) == (301, 300)


def test_weekday_monday_zero(spark):
    df = spark.createDataFrame([(ts("2013-01-01 00:00:00"),), (ts("2013-01-06 23:59:59"),), (ts("2013-01-07 00:00:00"),)], "t timestamp_ntz")
    assert [r.d for r in df.select(weekday0("t").alias("d")).collect()] == [1, 6, 0]


def _band_hits(spark, times, lo, hi, wrap=True):
    df = spark.createDataFrame([(ts(t),) for t in times], "t timestamp_ntz")
    return [r.b for r in df.select(in_time_of_day("t", lo, hi, wrap).alias("b")).collect()]


def test_band_closed_both_ends(spark):
    times = ["2013-01-01 09:29:59", "2013-01-01 09:30:00", "2013-02-11 10:00:00", "2013-03-01 10:00:00.000001"]
    assert _band_hits(spark, times, "09:30", "10:00") == [False, True, True, False]


def test_band_across_midnight(spark):
    times = ["2013-01-01 23:44:59", "2013-01-01 23:45:00", "2013-01-02 00:00:00", "2013-01-02 00:15:00", "2013-01-02 00:15:01"]
    assert _band_hits(spark, times, "23:45", "00:15") == [False, True, True, True, False]
    assert _band_hits(spark, times, "23:45", "00:15", wrap=False) == [False] * 5


def test_band_before_wraps():
    assert band_before("00:10", 30) == (dt.time(23, 40), dt.time(0, 10))
    assert band_before("10:00", 15) == (dt.time(9, 45), dt.time(10, 0))


def test_band_occurrence_date(spark):
    df = spark.createDataFrame(
        [(ts("2013-01-01 23:50:00"),), (ts("2013-01-02 00:05:00"),), (ts("2013-01-02 09:45:00"),)], "t timestamp_ntz"
    )
    got = [r.d for r in df.select(band_occurrence_date("t", "00:10").alias("d")).collect()]
    assert got == [dt.date(2013, 1, 2), dt.date(2013, 1, 2), dt.date(2013, 1, 3)]
    got = [r.d for r in df.select(band_occurrence_date("t", "10:00").alias("d")).collect()]
    assert got[2] == dt.date(2013, 1, 2)


def test_near_weight_strict(spark):
    ref = ts("2013-01-01 10:00:00")
    times = ["2013-01-31 09:59:59", "2013-01-31 10:00:00", "2012-12-02 10:00:01", "2012-12-02 10:00:00"]
    df = spark.createDataFrame([(ts(t),) for t in times], "t timestamp_ntz")
    assert [r.w for r in df.select(near_weight("t", ref).alias("w")).collect()] == [2, 1, 2, 1]


def test_tier_weight(spark):
    ref = ts("2013-03-19 10:00:00")
    times = [
        "2013-03-19 10:00:00",
        "2013-03-26 10:00:00",  # exactly 7 days: next tier
        "2013-04-01 10:00:00",
        "2013-04-08 09:59:59",
        "2013-04-15 09:00:00",  # within 28 days
        "2013-04-16 10:00:00",  # 28 days: outside every tier
    ]
    df = spark.createDataFrame([(ts(t),) for t in times], "t timestamp_ntz")
    got = [r.w for r in df.select(tier_weight("t", ref).alias("w")).collect()]
    assert got == [1.0, 0.75, 0.75, 0.5, 0.25, 0.0]
    compat = [r.w for r in df.select(tier_weight("t", ref, COMPAT_TIERS, None).alias("w")).collect()]
    assert compat == [1.0, 0.75, 0.75, 0.5, None, None]


def test_names():
    assert weekday_number("Miércoles") == 2
    assert weekday_number("sabado") == weekday_number("sábado") == 5
    assert month_number("enero") == 1 and month_number("Diciembre") == 12
    with pytest.raises(ValueError):
        weekday_number("funday")
    with pytest.raises(ValueError):
        month_number("brumario")
    assert weekday_number("funday", compat=True) == 0
    assert month_number("brumario", compat=True) == 1


def test_name_columns(spark):
    from tripgrid.functions import month_number_col, weekday_number_col

    df = spark.createDataFrame([(" Miércoles ", "Marzo"), ("domingo", "diciembre"), ("x", "y")], "d string, m string")
    got = [(r.d, r.m) for r in df.select(weekday_number_col("d").alias("d"), month_number_col("m").alias("m")).collect()]
    assert got == [(2, 3), (6, 12), (None, None)]


def test_windows_closed_variants(spark):
    from tripgrid.functions import in_window, in_window_at, ts_literal

    lo, hi = ts("2013-01-01 09:30:00"), ts("2013-01-01 10:00:00")
    times = ["2013-01-01 09:30:00", "2013-01-01 09:45:00", "2013-01-01 10:00:00"]
    df = spark.createDataFrame([(ts(t),) for t in times], "t timestamp_ntz")
    expected = {"both": [True, True, True], "right": [False, True, True], "left": [True, True, False], "neither": [False, True, False]}
    for closed, want in expected.items():
        a = [r.b for r in df.select(in_window("t", ts_literal(lo), ts_literal(hi), closed).alias("b")).collect()]
        b = [r.b for r in df.select(in_window_at("t", lo, hi, closed).alias("b")).collect()]
        assert a == b == want
    with pytest.raises(ValueError):
        in_window_at("t", lo, hi, "sideways")
