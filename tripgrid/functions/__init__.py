"""Column -> Column functions: grid cells, time windows, weights, names, money."""

from .grid import (
    FAR_LATITUDE,
    FAR_LONGITUDE,
    GRID_SIZE,
    LATITUDE_STEP,
    LONGITUDE_STEP,
    ORIGIN_LATITUDE,
    ORIGIN_LONGITUDE,
    cell_corner_lat,
    cell_corner_lon,
    in_grid,
    lat_cell,
    lon_cell,
)
from .money import cents, mean_cents
from .names import month_number, month_number_col, weekday_number, weekday_number_col
from .time import (
    band_before,
    band_occurrence_date,
    in_time_of_day,
    in_window,
    in_window_at,
    instant,
    minus_minutes,
    parse_time,
    time_of_day_micros,
    to_instant,
    ts_literal,
    ts_literal_for,
    ts_sql,
    weekday0,
)
from .weights import COMPAT_TIERS, TIERS, near_weight, tier_weight

__all__ = [
    "COMPAT_TIERS",
    "FAR_LATITUDE",
    "FAR_LONGITUDE",
    "GRID_SIZE",
    "LATITUDE_STEP",
    "LONGITUDE_STEP",
    "ORIGIN_LATITUDE",
    "ORIGIN_LONGITUDE",
    "TIERS",
    "band_before",
    "band_occurrence_date",
    "cell_corner_lat",
    "cell_corner_lon",
    "cents",
    "in_grid",
    "in_time_of_day",
    "in_window",
    "in_window_at",
    "instant",
    "lat_cell",
    "lon_cell",
    "mean_cents",
    "minus_minutes",
    "month_number",
    "month_number_col",
    "near_weight",
    "parse_time",
    "tier_weight",
    "time_of_day_micros",
    "to_instant",
    "ts_literal",
    "ts_literal_for",
    "ts_sql",
    "weekday0",
    "weekday_number",
    "weekday_number_col",
]
