"""Window and band predicates shared by the query plans.

Each helper returns the exact predicate of the query, plus, when the table
has the "by_date" storage layout, redundant predicates on the layout columns
that the exact one already implies. They change no result; they let the file
index skip date directories and the Parquet reader skip row groups:

* pickup/drop-off windows add ``fecha_subida``/``fecha_bajada`` ranges
  (partition pruning);
* time-of-day bands add ``segundo_subida``/``segundo_bajada`` ranges (the
  whole second of a time in ``[lo, hi]`` lies in ``[floor(lo), floor(hi)]``);
  files are sorted by pickup time inside each date, so those row-group
  statistics are tight;
* weekday filters add ``weekday(fecha_subida)`` (partition pruning).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.time import band_occurrence_date, crosses_midnight, parse_time, time_of_day_band_sql, window_sql

# Predicates are assembled as SQL text and parsed once (see functions.time).


def _has(trips: DataFrame, column: str) -> bool:
    return column in trips.columns


def _date_range_sql(column: str, lo: _dt.datetime, hi: _dt.datetime) -> str:
    return f"({column} BETWEEN DATE '{lo.date().isoformat()}' AND DATE '{hi.date().isoformat()}')"


def _window(trips: DataFrame, time_col: str, date_col: str, lo: _dt.datetime, hi: _dt.datetime, closed: str) -> Column:
    cond = window_sql(time_col, lo, hi, closed, trips.schema[time_col].dataType)
    if _has(trips, date_col):
        cond = f"{_date_range_sql(date_col, lo, hi)} AND {cond}"
    return F.expr(cond)


def pickup_window(trips: DataFrame, lo: _dt.datetime, hi: _dt.datetime, closed: str) -> Column:
    return _window(trips, S.PICKUP_TIME, S.PICKUP_DATE, lo, hi, closed)


def dropoff_window(trips: DataFrame, lo: _dt.datetime, hi: _dt.datetime, closed: str) -> Column:
    return _window(trips, S.DROPOFF_TIME, S.DROPOFF_DATE, lo, hi, closed)


def _seconds_band_sql(column: str, lo: _dt.time, hi: _dt.time, wrap: bool) -> str:
    lo_s = lo.hour * 3600 + lo.minute * 60 + lo.second
    hi_s = hi.hour * 3600 + hi.minute * 60 + hi.second
    if (lo_s, lo.microsecond) <= (hi_s, hi.microsecond):
        return f"({column} BETWEEN {lo_s} AND {hi_s})"
    if not wrap:
        return "false"
    return f"({column} >= {lo_s} OR {column} <= {hi_s})"


def _band(trips: DataFrame, time_col: str, second_col: str, lo, hi, wrap: bool) -> Column:
    lo_t, hi_t = parse_time(lo), parse_time(hi)
    cond = time_of_day_band_sql(time_col, lo_t, hi_t, wrap)
    if _has(trips, second_col):
        cond = f"{_seconds_band_sql(second_col, lo_t, hi_t, wrap)} AND {cond}"
    return F.expr(cond)


def pickup_band(trips: DataFrame, lo, hi, wrap: bool = True) -> Column:
    return _band(trips, S.PICKUP_TIME, S.PICKUP_SECOND, lo, hi, wrap)


def dropoff_band(trips: DataFrame, lo, hi, wrap: bool = True) -> Column:
    return _band(trips, S.DROPOFF_TIME, S.DROPOFF_SECOND, lo, hi, wrap)


def on_pickup_weekday(trips: DataFrame, weekday: int) -> Column:
    cond = f"{S.WEEKDAY} = {int(weekday)}"
    if _has(trips, S.PICKUP_DATE):
        cond = f"weekday({S.PICKUP_DATE}) = {int(weekday)} AND {cond}"
    return F.expr(cond)


def on_band_weekday(trips: DataFrame, weekday: int, lo, hi, time_col: str) -> Column:
    """The band occurrence that holds ``time_col`` falls on ``weekday``.

    Inside a day this is the pickup's weekday. Of a band across midnight the
    evening part belongs to the next day, when the band ends; the pickup or
    drop-off date is then that day or the one before, which prunes dates.
    """
    if not crosses_midnight(lo, hi):
        return on_pickup_weekday(trips, weekday)
    cond = F.weekday(band_occurrence_date(time_col, hi)) == int(weekday)
    date_col = S.PICKUP_DATE if time_col == S.PICKUP_TIME else S.DROPOFF_DATE
    if _has(trips, date_col):
        cond = F.expr(f"weekday({date_col}) IN ({int(weekday)}, {(int(weekday) - 1) % 7})") & cond
    return cond


def band_prefilter(trips: DataFrame, bands: dict[str, list[tuple]], wrap: bool = True) -> Column:
    """Pushable superset of "a time of day in one of its bands" (``bands`` by time column).

    Spark pushes an OR to Parquet only when both sides are pushable, so the
    coarse second-of-day ranges are offered as their own conjunct. TRUE
    without the layout columns.
    """
    seconds = {S.PICKUP_TIME: S.PICKUP_SECOND, S.DROPOFF_TIME: S.DROPOFF_SECOND}
    if not all(_has(trips, seconds[c]) for c in bands):
        return F.lit(True)
    ranges = [
        _seconds_band_sql(seconds[c], parse_time(lo), parse_time(hi), wrap) for c, of_column in bands.items() for lo, hi in of_column
    ]
    return F.expr(" OR ".join(ranges))
