"""Most profitable areas: at an instant (Q2) and seasonal (Q2S).

profit(cell) = benefit(cell) / divisor(free taxis in cell)

Both read the trips once: ``operators.areas`` makes tagged events of them, one
aggregate reduces these by taxi and by cell, a second one puts a cell's free
taxis and benefit together. A cell with benefit and no free taxi has count 0
(what a left join would give as NULL). Cells are bounded by the 300 x 300 grid,
so the last aggregate is at most 90,000 rows whatever the input. Top-k is per task.

Money is in cents; ``currency_units`` turns the two amounts into currency.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.names import weekday_number
from ..functions.time import band_before, band_occurrence_date, crosses_midnight, instant, minus_minutes, to_instant, ts_sql
from ..functions.weights import COMPAT_TIERS, TIERS, tier_weight
from ..operators.areas import (
    BENEFIT_SQL,
    SEASONAL_BENEFIT_SQL,
    WEIGHTED_FREE_SQL,
    Base,
    area_cells,
    packable,
    taxi_state,
    with_benefit,
)
from ..operators.topk import top_k
from ..sources.trip_store import Trips, in_band_sql, in_window_sql, on_weekday_sql, stored
from .common import band_prefilter, dropoff_band, dropoff_window, on_band_weekday, on_pickup_weekday, pickup_band, pickup_window

# Amounts of the results, in cents.
AMOUNTS = ("beneficios", "beneficio")


def currency_units(ranked: DataFrame) -> DataFrame:
    """The amounts of a result in currency units, as the original printed them."""
    return ranked.withColumns({c: F.col(c) / 100 for c in AMOUNTS if c in ranked.columns})


@dataclass(frozen=True)
class AreaQuery:
    """Trips of a query and what each of them counts as (arguments of ``area_cells``)."""

    trips: DataFrame
    down: Column
    up: Column
    benefit: Column
    occurrence: tuple[Column, Column] | None = None
    influence: Column | None = None
    tiebreak: Sequence[str] = ()
    base: Base | None = None

    def cells(self) -> DataFrame:
        return area_cells(self.trips, self.down, self.up, self.benefit, self.occurrence, self.influence, self.tiebreak, self.base)

    def state(self) -> DataFrame:
        return taxi_state(self.trips, self.down, self.up, self.occurrence, self.tiebreak, self.base)


# ---------------------------------------------------------------------------
# Q2
# ---------------------------------------------------------------------------


def instant_query(
    trips: Trips,
    at: str | _dt.datetime,
    taxi_minutes: float = 30,
    benefit_minutes: float = 15,
    tiebreak: Sequence[str] = (),
) -> AreaQuery:
    """Taxis and benefit trips of the instant query."""
    t = to_instant(at)
    t_taxi = minus_minutes(t, taxi_minutes)
    t_benefit = minus_minutes(t, benefit_minutes)
    first = min(t_taxi, t_benefit)
    trips = stored(trips, f"{in_window_sql(S.DROPOFF_TIME, first, t)} OR {in_window_sql(S.PICKUP_TIME, t_taxi, t)}")
    base = ts_sql(t_taxi, trips.schema[S.DROPOFF_TIME].dataType)
    return AreaQuery(
        trips,
        down=dropoff_window(trips, t_taxi, t, "right"),
        up=pickup_window(trips, t_taxi, t, "right"),
        benefit=dropoff_window(trips, t_benefit, t, "right"),
        tiebreak=tiebreak,
        base=(lambda occurrence: base) if packable(taxi_minutes) else None,
    )


def profitable_areas(
    trips: Trips,
    at: str | _dt.datetime,
    taxi_minutes: float = 30,
    benefit_minutes: float = 15,
    k: int = 10,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Top ``k`` cells by ``(mean fare + mean tip) / divisor`` at instant ``at``.

    * free taxis: last drop-off in ``(at - taxi_minutes, at]`` with no later
      pickup in ``(at - taxi_minutes, at]``, counted by drop-off cell;
    * benefit: trips that ended in ``(at - benefit_minutes, at]``, by pickup cell;
    * divisor: ``free + 1`` if the cell has free taxis, else 1.

    Columns: rank, cuad_latitud, cuad_longitud, beneficios (cents),
    taxis_libres, beneficio (cents per divisor).
    """
    cells = instant_query(trips, at, taxi_minutes, benefit_minutes, tiebreak).cells()
    result = with_benefit(cells).selectExpr(
        *S.AREA,
        f"{BENEFIT_SQL} AS beneficios",
        "taxis_libres",
        f"({BENEFIT_SQL}) / CAST(CASE WHEN taxis_libres > 0 THEN taxis_libres + 1 ELSE 1 END AS DOUBLE) AS beneficio",
    )
    return top_k(result, "beneficio", S.AREA, k)


# ---------------------------------------------------------------------------
# Q2S
# ---------------------------------------------------------------------------


def seasonal_instant(mmdd: str, hhmm: str, year: int = 2013) -> _dt.datetime:
    return instant(f"{year}-{mmdd}", hhmm)


def seasonal_query(
    trips: Trips,
    weekday: str | int,
    mmdd: str,
    hhmm: str,
    year: int = 2013,
    taxi_minutes: float = 30,
    benefit_minutes: float = 15,
    compat: bool = False,
    tiebreak: Sequence[str] = (),
) -> AreaQuery:
    """Taxis, benefit trips and influence of the seasonal query."""
    day = weekday_number(weekday, compat)
    ref = seasonal_instant(mmdd, hhmm, year)
    taxi_lo, taxi_hi = band_before(hhmm, taxi_minutes)
    ben_lo, ben_hi = band_before(hhmm, benefit_minutes)
    wrap = not compat
    midnight = wrap and crosses_midnight(taxi_lo, taxi_hi)
    bands = {S.DROPOFF_TIME: [(taxi_lo, taxi_hi), (ben_lo, ben_hi)], S.PICKUP_TIME: [(taxi_lo, taxi_hi)]}
    touched = " OR ".join(in_band_sql(c, lo, hi, wrap) for c, of_column in bands.items() for lo, hi in of_column)
    # Of a band across midnight, an event's date is that weekday or the one before.
    days = f"{on_weekday_sql(S.DROPOFF_TIME, day, True)} OR {on_weekday_sql(S.PICKUP_TIME, day, True)}" if midnight else on_weekday_sql(S.PICKUP_TIME, day)
    trips = stored(trips, f"({touched}) AND ({days})")
    down = dropoff_band(trips, taxi_lo, taxi_hi, wrap)
    up = pickup_band(trips, taxi_lo, taxi_hi, wrap)
    benefit = dropoff_band(trips, ben_lo, ben_hi, wrap)
    occurrence = None
    if not compat:
        occurrence = (
            band_occurrence_date(S.DROPOFF_TIME, taxi_hi),
            band_occurrence_date(S.PICKUP_TIME, taxi_hi),
        )
    rows = trips.where(band_prefilter(trips, bands, wrap))
    if midnight:
        # Each event belongs to the weekday of its own band occurrence.
        ended = on_band_weekday(trips, day, taxi_lo, taxi_hi, S.DROPOFF_TIME)
        down, benefit = down & ended, benefit & ended
        up = up & on_band_weekday(trips, day, taxi_lo, taxi_hi, S.PICKUP_TIME)
    else:
        rows = rows.where(on_pickup_weekday(trips, day))
    data_type = trips.schema[S.DROPOFF_TIME].dataType
    influence = tier_weight(S.DROPOFF_TIME, ref, COMPAT_TIERS if compat else TIERS, None if compat else 0.0, data_type)
    # An occurrence ends on its date and starts on the day before at the earliest.
    base = None if compat else (lambda key: f"CAST(date_sub({key}, 1) AS {data_type.simpleString().upper()})")
    return AreaQuery(rows, down, up, benefit, occurrence, influence, tiebreak, base)


def profitable_areas_seasonal(
    trips: Trips,
    weekday: str | int,
    mmdd: str,
    hhmm: str,
    year: int = 2013,
    taxi_minutes: float = 30,
    benefit_minutes: float = 15,
    k: int = 10,
    compat: bool = False,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Top ``k`` cells over every date with the pickup weekday, in time-of-day bands.

    Influence of a row = tier of its drop-off time's distance to
    ``{year}-{mmdd} {hhmm}``. Per cell:
    ``weighted_free = round(free count x mean influence of free taxis)`` and
    ``benefit = (mean fare + mean tip) x mean influence of benefit trips``.

    Default: taxi state per (taxi, band occurrence date), bands wrap midnight
    (and then belong to the weekday on which they end),
    four tiers with 0 outside, ``profit = benefit / (coalesce(weighted_free, 0) + 1)``.
    ``compat`` reproduces the original: state over all dates at once, no
    wrap, three tiers with NULL outside, ``profit = benefit / weighted_free``
    (NULL without free taxis or when it rounds to 0).

    Columns: rank, cuad_latitud, cuad_longitud, beneficios,
    proporcion_taxis_libres, beneficio.
    """
    cells = seasonal_query(trips, weekday, mmdd, hhmm, year, taxi_minutes, benefit_minutes, compat, tiebreak).cells()
    if compat:
        profit = f"try_divide({SEASONAL_BENEFIT_SQL}, {WEIGHTED_FREE_SQL})"
    else:
        profit = f"{SEASONAL_BENEFIT_SQL} / (coalesce({WEIGHTED_FREE_SQL}, 0.0D) + 1)"
    result = with_benefit(cells).selectExpr(
        *S.AREA,
        f"{SEASONAL_BENEFIT_SQL} AS beneficios",
        f"{WEIGHTED_FREE_SQL} AS proporcion_taxis_libres",
        f"{profit} AS beneficio",
    )
    return top_k(result, "beneficio", S.AREA, k)
