"""Most frequent routes: at an instant (Q1) and seasonal (Q1S).

Physical shape: Parquet scan with pushed range filters -> partial aggregate ->
one hash exchange on the route -> final aggregate -> per-task top-k -> merge.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame

from .. import schema as S
from ..functions.names import month_number, weekday_number
from ..functions.time import band_before, crosses_midnight, minus_minutes, parse_time, to_instant
from ..functions.weights import NEAR_DAYS, near_weight
from ..operators.routes import route_counts, weighted_route_counts
from ..operators.topk import top_k
from ..sources.trip_store import Trips, in_band_sql, in_window_sql, on_weekday_sql, stored
from .common import dropoff_band, dropoff_window, on_band_weekday, on_pickup_weekday, pickup_band, pickup_window


def routes_in_window(trips: Trips, at: str | _dt.datetime, minutes: float = 30) -> DataFrame:
    """Trips that both start and end in the closed window ``[at - minutes, at]``."""
    hi = to_instant(at)
    lo = minus_minutes(hi, minutes)
    trips = stored(trips, f"{in_window_sql(S.PICKUP_TIME, lo, hi)} AND {in_window_sql(S.DROPOFF_TIME, lo, hi)}")
    return trips.where(pickup_window(trips, lo, hi, "both") & dropoff_window(trips, lo, hi, "both"))


def frequent_routes(
    trips: Trips, at: str | _dt.datetime, minutes: float = 30, k: int = 10
) -> DataFrame:
    """Top ``k`` routes by trips started and finished in ``[at - minutes, at]``.

    Columns: rank, 4 route cells (lon before lat), viajes.
    """
    return top_k(route_counts(routes_in_window(trips, at, minutes)), "viajes", S.ROUTE, k)


def seasonal_reference(year: int, month: str | int, hhmm: str, compat: bool = False) -> _dt.datetime:
    """First day of ``month`` in ``year`` at ``hhmm``."""
    return _dt.datetime.combine(_dt.date(year, month_number(month, compat), 1), parse_time(hhmm))


def seasonal_route_trips(
    trips: Trips,
    weekday: str | int,
    hhmm: str,
    minutes: float = 30,
    compat: bool = False,
) -> DataFrame:
    """Trips on the pickup weekday whose pickup and drop-off times of day are in the band.

    A band across midnight belongs to the weekday on which it ends.

    ``compat`` reproduces the original program, which computed the two band
    flags but never filtered on them, so every trip of the weekday counts.
    """
    day = weekday_number(weekday, compat)
    if compat:
        trips = stored(trips, on_weekday_sql(S.PICKUP_TIME, day))
        return trips.where(on_pickup_weekday(trips, day))
    lo_t, hi_t = band_before(hhmm, minutes)
    touched = [in_band_sql(c, lo_t, hi_t) for c in (S.PICKUP_TIME, S.DROPOFF_TIME)]
    trips = stored(trips, " AND ".join([*touched, on_weekday_sql(S.PICKUP_TIME, day, crosses_midnight(lo_t, hi_t))]))
    out = trips.where(on_band_weekday(trips, day, lo_t, hi_t, S.PICKUP_TIME))
    return out.where(pickup_band(trips, lo_t, hi_t) & dropoff_band(trips, lo_t, hi_t))


def frequent_routes_seasonal(
    trips: Trips,
    month: str | int,
    weekday: str | int,
    hhmm: str,
    year: int = 2013,
    minutes: float = 30,
    near_days: float = NEAR_DAYS,
    near: int = 2,
    far: int = 1,
    k: int = 10,
    compat: bool = False,
) -> DataFrame:
    """Top ``k`` routes over every date with the given weekday and time-of-day band.

    Each trip weighs ``near`` when its pickup is strictly within ``near_days``
    of the first of ``month`` at ``hhmm``, else ``far``.
    Columns: rank, 4 route cells, frecuencia.
    """
    ref = seasonal_reference(year, month, hhmm, compat)
    sel = seasonal_route_trips(trips, weekday, hhmm, minutes, compat)
    weight = near_weight(S.PICKUP_TIME, ref, near_days, near, far, sel.schema[S.PICKUP_TIME].dataType)
    return top_k(weighted_route_counts(sel, weight), "frecuencia", S.ROUTE, k)
