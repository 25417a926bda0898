"""Seasonal routes from a stored partial aggregate (Q1S without reading the log again).

``route_rollup`` counts trips by pickup date, quarter hour of pickup and of
drop-off, and route. A seasonal query weighs and sums the rows of the quarter
hours that lie wholly in its band; trips of quarter hours that the band, or the
border of the near period, cuts are read from the log. Both together are the
exact answer: every trip is in one of them. A band on quarter hours reads from
the log only the trips that start or end at its last instant.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.names import weekday_number
from ..functions.time import band_before, crosses_midnight, time_of_day_band_sql, time_to_micros, ts_sql
from ..functions.weights import FAR_WEIGHT, NEAR_DAYS, NEAR_WEIGHT, near_weight
from ..operators.topk import top_k
from ..sources.trip_store import Trips, in_band_sql, in_window_sql, on_weekday_sql, stored
from .frequent_routes import seasonal_reference, seasonal_route_trips

SLOT_SECONDS = 900
_SLOT_MICROS = SLOT_SECONDS * 1_000_000
_SLOTS = 86_400 // SLOT_SECONDS

DATE, PICKUP_SLOT, DROPOFF_SLOT, TRIPS = "fecha", "franja_subida", "franja_bajada", "viajes"

ROLLUP_SCHEMA = T.StructType(
    [
        T.StructField(DATE, T.DateType(), True),
        T.StructField(PICKUP_SLOT, T.IntegerType(), True),
        T.StructField(DROPOFF_SLOT, T.IntegerType(), True),
        *[T.StructField(c, T.LongType(), True) for c in S.ROUTE],
        T.StructField(TRIPS, T.LongType(), True),
        T.StructField(S.WEEKDAY, T.IntegerType(), True),
    ]
)


def _slot(column: str) -> Column:
    return F.expr(f"CAST((hour({column}) * 3600 + minute({column}) * 60 + second({column})) DIV {SLOT_SECONDS} AS INT)")


def route_rollup(trips: DataFrame) -> DataFrame:
    """Trips by (pickup date, quarter hours of pickup and drop-off, route), and the date's weekday."""
    keys = [F.to_date(S.PICKUP_TIME).alias(DATE), _slot(S.PICKUP_TIME).alias(PICKUP_SLOT), _slot(S.DROPOFF_TIME).alias(DROPOFF_SLOT)]
    return trips.groupBy(*keys, *S.ROUTE).agg(F.count(F.lit(1)).alias(TRIPS)).withColumn(S.WEEKDAY, F.weekday(DATE))


def write_route_rollup(trips: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Store the rollup by weekday, ordered by quarter hour, so a band reads few row groups of one weekday."""
    rows = route_rollup(trips).hint("rebalance", S.WEEKDAY).sortWithinPartitions(S.WEEKDAY, PICKUP_SLOT, DROPOFF_SLOT, DATE)
    rows.write.mode(mode).partitionBy(S.WEEKDAY).parquet(path)


def read_route_rollup(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ROLLUP_SCHEMA).parquet(path)


@dataclass(frozen=True)
class BandSlots:
    """Quarter hours that lie in a closed band, and the parts of others that do (as closed ranges of times)."""

    whole: list[int]
    cut: list[tuple[_dt.time, _dt.time]]


def _time(micros: int) -> _dt.time:
    return (_dt.datetime(2000, 1, 1) + _dt.timedelta(microseconds=micros)).time()


def band_slots(lo: _dt.time, hi: _dt.time) -> BandSlots:
    """The quarter hours of the band ``[lo, hi]``, which crosses midnight if ``lo > hi``."""
    lo_us, hi_us = time_to_micros(lo), time_to_micros(hi)
    day = _SLOTS * _SLOT_MICROS
    parts = [(lo_us, hi_us)] if lo_us <= hi_us else [(lo_us, day - 1), (0, hi_us)]
    whole, cut = [], []
    for slot in range(_SLOTS):
        first, last = slot * _SLOT_MICROS, (slot + 1) * _SLOT_MICROS - 1
        for a, b in parts:
            if a <= first and last <= b:
                whole.append(slot)
            elif a <= last and first <= b:
                cut.append((_time(max(a, first)), _time(min(b, last))))
    return BandSlots(whole, cut)


def frequent_routes_seasonal_from_rollup(
    rollup: DataFrame,
    trips: Trips,
    month: str | int,
    weekday: str | int,
    hhmm: str,
    year: int = 2013,
    minutes: float = 30,
    near_days: float = NEAR_DAYS,
    near: int = NEAR_WEIGHT,
    far: int = FAR_WEIGHT,
    k: int = 10,
) -> DataFrame:
    """``frequent_routes_seasonal`` from the rollup of ``trips`` and the trips of the quarter hours that are cut."""
    ref = seasonal_reference(year, month, hhmm)
    day = weekday_number(weekday)
    lo, hi = band_before(hhmm, minutes)
    slots = band_slots(lo, hi)
    midnight = crosses_midnight(lo, hi)

    # The two borders of the near period each cut at most one quarter hour of one date.
    borders = []
    for border in (ref - _dt.timedelta(days=near_days), ref + _dt.timedelta(days=near_days)):
        midnight_of = _dt.datetime.combine(border.date(), _dt.time())
        slot = int((border - midnight_of).total_seconds()) // SLOT_SECONDS
        borders.append((midnight_of + _dt.timedelta(seconds=slot * SLOT_SECONDS), slot))
    at_border = " OR ".join(f"({DATE} = DATE '{start.date().isoformat()}' AND {PICKUP_SLOT} = {slot})" for start, slot in borders)
    listed = ", ".join(map(str, slots.whole)) or "NULL"
    occurrence = DATE
    weekdays = str(day)
    if midnight:
        # The evening of a band across midnight belongs to the day on which the band ends.
        evening = -(-time_to_micros(lo) // _SLOT_MICROS)
        occurrence = f"CASE WHEN {PICKUP_SLOT} >= {evening} THEN date_add({DATE}, 1) ELSE {DATE} END"
        weekdays = f"{day}, {(day - 1) % 7}"
    counted = rollup.where(
        f"{S.WEEKDAY} IN ({weekdays}) AND {PICKUP_SLOT} IN ({listed}) AND {DROPOFF_SLOT} IN ({listed}) "
        f"AND weekday({occurrence}) = {day} AND NOT coalesce({at_border}, false)"
    )
    start = f"timestampadd(SECOND, {PICKUP_SLOT} * {SLOT_SECONDS}, CAST({DATE} AS TIMESTAMP_NTZ))"
    weight = near_weight(start, ref, near_days, near, far)
    counted = counted.select(*S.ROUTE, (weight * F.col(TRIPS)).alias("peso"))

    # Trips that no whole quarter hour counts.
    touched = [in_band_sql(c, a, b) for a, b in slots.cut for c in (S.PICKUP_TIME, S.DROPOFF_TIME)]
    border_files = [in_window_sql(S.PICKUP_TIME, s, s + _dt.timedelta(seconds=SLOT_SECONDS)) for s, _ in borders]
    in_bands = [in_band_sql(c, lo, hi) for c in (S.PICKUP_TIME, S.DROPOFF_TIME)]  # as of the query over all trips
    where = " AND ".join([f"({' OR '.join([*touched, *border_files])})", *in_bands, on_weekday_sql(S.PICKUP_TIME, day, midnight)])
    log = stored(trips, where)
    in_cut = [time_of_day_band_sql(c, a, b) for a, b in slots.cut for c in (S.PICKUP_TIME, S.DROPOFF_TIME)]
    data_type = log.schema[S.PICKUP_TIME].dataType
    for s, _ in borders:
        end = s + _dt.timedelta(seconds=SLOT_SECONDS)
        in_cut.append(f"({S.PICKUP_TIME} >= {ts_sql(s, data_type)} AND {S.PICKUP_TIME} < {ts_sql(end, data_type)})")
    rows = seasonal_route_trips(log, weekday, hhmm, minutes).where(" OR ".join(in_cut))
    rows = rows.select(*S.ROUTE, near_weight(S.PICKUP_TIME, ref, near_days, near, far, data_type).cast("bigint").alias("peso"))

    total = counted.unionByName(rows).groupBy(*S.ROUTE).agg(F.sum("peso").alias("frecuencia"))
    return top_k(total, "frecuencia", S.ROUTE, k)
