"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads ``{sf_dir}/lineitem.parquet`` (the raw trip log is derived
from it, see ``sources.fixture``) and runs over the whole table. Parameters
are the instants used for the checks in FIXTURES.md.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schema as S
from .functions.time import band_before, in_time_of_day, ts_literal
from .operators.areas import area_benefit, free_taxis_per_cell, seasonal_area_benefit, weighted_free_taxis
from .operators.clean import clean_report, malformed_report, process_trips
from .operators.grid import grid_cells
from .operators.routes import route_counts
from .operators.sample import ladder_summary, prefix_sample
from .operators.taxis import latest_per_key, with_in_use_flag
from .plans.benchmark import run_process, scan_benchmark
from .plans.frequent_routes import frequent_routes, frequent_routes_seasonal
from .plans.profitable_areas import instant_query, profitable_areas, profitable_areas_seasonal, seasonal_query
from .plans.result_line import route_line, area_line
from .plans.seasonal_rollup import (
    frequent_routes_seasonal_from_rollup,
    read_route_rollup,
    route_rollup,
    write_route_rollup,
)
from .sources.fixture import computed_once, raw_trips
from .sources.trip_store import compact_trips
from .sources.trips_io import open_trips, read_raw_trips, read_trips, read_trips_csv, write_trips, write_trips_csv
from .session import scratch_path

# Query parameters of the checks (a Tuesday; see FIXTURES.md section 6).
AT = "2013-03-19 10:00"
SEASON_MONTH, SEASON_WEEKDAY, SEASON_HHMM = "enero", "martes", "10:00"
AREA_WEEKDAY, AREA_MMDD, AREA_HHMM = "martes", "03-19", "10:00"
TIEBREAK = ("k", S.LICENSE)
# A second parameter set: other weekday (Friday), months and times of day.
AT_B = "2013-02-05 09:45"
SEASON_B = ("marzo", "viernes", "09:50")
AT_AREA_B = "2013-01-22 09:50"
AREA_B = ("viernes", "02-15", "09:55")
PREFIX_ROWS = 5000
# Few enough rows that the last second, or the rows without a time, are divided by counts.
PREFIX_BOUND = 50
# Few enough rows a file that the busy dates are cut into pieces of the day.
STORED_ROWS = 2000


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed trips (18 columns + ``k``) derived from the driver's lineitem."""
    return process_trips(computed_once(raw_trips(spark, sf_dir)), extra=("k",))


def checksum(c: str):
    """The sum of a bigint column modulo 2^64 (two's complement): the plain sum wherever that fits a bigint.

    The sum of ``k`` over a large log does not fit; it is taken in decimals,
    so that nothing overflows on the way.
    """
    low = F.pmod(F.sum(F.col(c).cast("decimal(38,0)")), F.lit(Decimal(2**64)))
    return F.when(low >= F.lit(Decimal(2**63)), low - F.lit(Decimal(2**64))).otherwise(low).cast("bigint")


def _q_raw_profile(spark, sf_dir):
    raw = raw_trips(spark, sf_dir)
    return raw.agg(
        F.count(F.lit(1)).alias("n_raw"),
        F.count_if(F.col(S.MEDALLION) == "").alias("n_sin_medallon"),
        F.count_if(F.col(S.PAYMENT) == "CSH").alias("n_csh"),
        F.count_if(F.col(S.PAYMENT) == "CRD").alias("n_crd"),
        F.count_if(F.col(S.PAYMENT) == "UNK").alias("n_unk"),
        F.sum(S.DURATION).cast("bigint").alias("sum_duracion"),
        F.sum((F.col(S.FARE) * 100).cast("bigint")).alias("sum_tarifa_c"),
        F.sum((F.col(S.TIP) * 100).cast("bigint")).alias("sum_propina_c"),
        checksum("k").alias("sum_k"),
        F.min(S.PICKUP_TIME).alias("min_subida"),
        F.max(S.DROPOFF_TIME).alias("max_bajada"),
    )


def _unscaled(c: str):
    return (F.col(c) * F.lit(10**14)).cast("bigint")


def _q_clean_trips(spark, sf_dir):
    t = trips(spark, sf_dir)
    return t.select(
        "k",
        S.MEDALLION,
        S.LICENSE,
        S.PICKUP_TIME,
        S.DROPOFF_TIME,
        S.DURATION,
        _unscaled(S.PICKUP_LON).alias("lon_subida_e14"),
        _unscaled(S.PICKUP_LAT).alias("lat_subida_e14"),
        _unscaled(S.DROPOFF_LON).alias("lon_bajada_e14"),
        _unscaled(S.DROPOFF_LAT).alias("lat_bajada_e14"),
        S.PAYMENT,
        (F.col(S.FARE) * 100).cast("bigint").alias("tarifa_c"),
        (F.col(S.TIP) * 100).cast("bigint").alias("propina_c"),
        (F.col(S.TOTAL) * 100).cast("bigint").alias("total_c"),
    )


def _q_clean_report(spark, sf_dir):
    return clean_report(raw_trips(spark, sf_dir))


def _q_clean_report_any_differs(spark, sf_dir):
    """Cleaning report with the looser "moved" rule (any coordinate differs)."""
    return clean_report(raw_trips(spark, sf_dir), moved_mode="any_differs")


def _q_trip_cells(spark, sf_dir):
    return trips(spark, sf_dir).select("k", *S.DERIVED_COLUMNS)


def _q_clean_report_compat(spark, sf_dir):
    return clean_report(raw_trips(spark, sf_dir), compat=True)


def _q_grid_cells(spark, sf_dir):
    """The grid dimension with the trips that start in each cell."""
    counts = trips(spark, sf_dir).groupBy(S.PICKUP_LON_CELL, S.PICKUP_LAT_CELL).agg(F.count(F.lit(1)).alias("n"))
    here = (F.col("X") == F.col(S.PICKUP_LON_CELL)) & (F.col("Y") == F.col(S.PICKUP_LAT_CELL))
    return grid_cells(spark).join(counts, here, "left").select(
        "X", "Y", "LATITUD", "LONGITUD", F.coalesce("n", F.lit(0).cast("bigint")).alias("viajes")
    )


def _raw_csv(spark, sf_dir):
    """The raw log as the headerless CSV that the original job reads."""
    path = scratch_path(spark, "raw-csv")
    raw_trips(spark, sf_dir).drop("k").write.option("timestampNTZFormat", S.TIME_FORMAT).csv(path)
    return path


# Text that no reader understands, in one record of so many, by field.
BROKEN = {211: (S.DURATION, "x"), 223: (S.DROPOFF_TIME, "sin hora"), 233: (S.FARE, "12.x")}
SHORT, LONG = 227, 229


def _broken_csv(spark, sf_dir):
    """The raw log as CSV with unreadable fields, and records of too few and too many fields."""
    raw = raw_trips(spark, sf_dir)
    texts = []
    for f in S.RAW_SCHEMA.fields:
        text = F.date_format(f.name, S.TIME_FORMAT) if f.name in (S.PICKUP_TIME, S.DROPOFF_TIME) else F.col(f.name).cast("string")
        for every, (name, broken) in BROKEN.items():
            if name == f.name:
                text = F.when(F.col("k") % every == 0, F.lit(broken)).otherwise(text)
        texts.append(F.coalesce(text, F.lit("")))
    # Every field is mentioned once, so it is computed once; concat_ws leaves NULLs out.
    short, long = (F.coalesce(F.col("k") % every == 0, F.lit(False)) for every in (SHORT, LONG))
    line = F.concat_ws(",", *texts[:-1], F.when(~short, texts[-1]), F.when(long, F.lit("sobra,sobra")))
    path = scratch_path(spark, "broken-csv")
    raw.select(line.alias("value")).write.text(path)
    return path


def _q_quarantine_report(spark, sf_dir):
    """Raw records = stored + rejected by the rules + malformed."""
    return clean_report(read_raw_trips(spark, _broken_csv(spark, sf_dir), rescue=True))


def _q_quarantine_fields(spark, sf_dir):
    """What is wrong with the malformed records that the job put aside."""
    out, aside = scratch_path(spark, "processed"), scratch_path(spark, "quarantine")
    run_process(spark, _broken_csv(spark, sf_dir), out, quarantine_path=aside)
    return malformed_report(spark.read.parquet(aside))


def _q_quarantine_process(spark, sf_dir):
    """The table that the job stores of the log with malformed records."""
    out, aside = scratch_path(spark, "processed"), scratch_path(spark, "quarantine")
    run_process(spark, _broken_csv(spark, sf_dir), out, quarantine_path=aside)
    columns = [c for c in S.PROCESSED_COLUMNS if c not in (S.PICKUP_LON, S.PICKUP_LAT, S.DROPOFF_LON, S.DROPOFF_LAT, S.FARE, S.TIP, S.TOTAL)]
    return open_trips(spark, out).frame().select(*columns, (F.col(S.FARE) * 100).cast("bigint").alias("tarifa_c"))


def _rolled_up(spark, sf_dir, *season):
    """Seasonal routes from the stored rollup and the stored trips."""
    path = scratch_path(spark, "rollup")
    log = _stored(spark, sf_dir)
    write_route_rollup(log.frame(), path)
    return frequent_routes_seasonal_from_rollup(read_route_rollup(spark, path), log, *season)


def _q_rollup_routes(spark, sf_dir):
    return _rolled_up(spark, sf_dir, SEASON_MONTH, SEASON_WEEKDAY, SEASON_HHMM)


def _q_rollup_routes_b(spark, sf_dir):
    return _rolled_up(spark, sf_dir, *SEASON_B)


def _q_rollup_routes_midnight(spark, sf_dir):
    return _rolled_up(spark, sf_dir, *MIDNIGHT_ROUTES)


def _q_route_rollup(spark, sf_dir):
    return route_rollup(trips(spark, sf_dir))


def _q_file_index(spark, sf_dir):
    """Rows that the file index counts, by pickup date."""
    files = _stored(spark, sf_dir).files()
    return files.groupBy(F.to_date("min_hora_subida").alias(S.PICKUP_DATE)).agg(
        F.sum("filas").alias("viajes"), F.min("min_hora_subida").alias("primera"), F.max("max_hora_bajada").alias("ultima")
    )


def _q_compacted(spark, sf_dir):
    """A table loaded in two parts, compacted, read by its index."""
    path = scratch_path(spark, "parts")
    t = trips(spark, sf_dir)
    for part in range(2):
        write_trips(t.where(F.col("k") % 2 == part), path, mode="append", layout="by_date", rows_per_file=5000)
    return _roundtrip_summary(compact_trips(spark, path, rows_per_file=20_000).frame())


def _q_areas_packed(spark, sf_dir):
    """Ties of the last drop-off go to the greatest cell: times and cells in one long."""
    return profitable_areas(trips(spark, sf_dir), AT)


def _q_areas_seasonal_packed(spark, sf_dir):
    return profitable_areas_seasonal(trips(spark, sf_dir), AREA_WEEKDAY, AREA_MMDD, AREA_HHMM)


def _q_areas_midnight_packed(spark, sf_dir):
    return profitable_areas_seasonal(_stored(spark, sf_dir), *MIDNIGHT_AREAS)


def _q_prefix_null_tail(spark, sf_dir):
    """A prefix that ends among rows without a time, a third of the log and more."""
    raw = raw_trips(spark, sf_dir).withColumn(S.PICKUP_TIME, F.when(F.col("k") % 5 > 1, F.col(S.PICKUP_TIME)))
    n = raw.count() * 9 // 10
    found = select_prefix(raw, n, (S.PICKUP_TIME, "k", S.MEDALLION, S.LICENSE))
    return found.select("k", S.MEDALLION, S.PICKUP_TIME)


def _q_prefix_hot_second(spark, sf_dir):
    """A prefix that ends in a second with a third of the log."""
    hot = F.lit("2013-01-05 08:00:00").cast("timestamp_ntz")
    raw = raw_trips(spark, sf_dir).withColumn(S.PICKUP_TIME, F.when(F.col("k") % 3 == 0, hot).otherwise(F.col(S.PICKUP_TIME)))
    n = raw.count() // 4
    found = select_prefix(raw, n, (S.PICKUP_TIME, S.PAYMENT, S.LICENSE, "k", S.MEDALLION))
    return found.select("k", S.MEDALLION, S.PICKUP_TIME)


def select_prefix(raw, n, order):
    """``prefix_sample`` that puts at most ``PREFIX_BOUND`` rows in order."""
    return prefix_sample(raw, n, order, bound=PREFIX_BOUND)


def _q_process_csv(spark, sf_dir):
    """The whole job: raw CSV -> cleaned and enriched table -> read back."""
    path = scratch_path(spark, "processed")
    run_process(spark, _raw_csv(spark, sf_dir), path)
    return read_trips(spark, path).select(
        S.MEDALLION,
        S.LICENSE,
        S.PICKUP_TIME,
        S.DROPOFF_TIME,
        S.DURATION,
        _unscaled(S.PICKUP_LON).alias("lon_subida_e14"),
        _unscaled(S.DROPOFF_LAT).alias("lat_bajada_e14"),
        S.PAYMENT,
        (F.col(S.FARE) * 100).cast("bigint").alias("tarifa_c"),
        (F.col(S.TIP) * 100).cast("bigint").alias("propina_c"),
        (F.col(S.TOTAL) * 100).cast("bigint").alias("total_c"),
        *S.DERIVED_COLUMNS,
    )


def _q_prefix_sample_large(spark, sf_dir):
    """Nine tenths of the log."""
    raw = raw_trips(spark, sf_dir)
    n = raw.count() * 9 // 10
    return prefix_sample(raw, n, order=(S.PICKUP_TIME, "k", S.MEDALLION, S.LICENSE)).select("k", S.MEDALLION, S.PICKUP_TIME)


def _q_prefix_sample(spark, sf_dir):
    raw = raw_trips(spark, sf_dir)
    sample = prefix_sample(raw, PREFIX_ROWS, order=(S.PICKUP_TIME, "k", S.MEDALLION, S.LICENSE))
    return sample.select("k", S.MEDALLION, S.PICKUP_TIME, S.DROPOFF_TIME, S.PAYMENT)


def _q_size_ladder(spark, sf_dir):
    """The 13 prefix sizes of the time-ordered raw log, their rows and last pickup."""
    raw = raw_trips(spark, sf_dir)
    return ladder_summary(raw, order=(S.PICKUP_TIME, "k", S.MEDALLION, S.LICENSE))


def _q_frequent_routes(spark, sf_dir):
    return frequent_routes(trips(spark, sf_dir), AT)


def _q_route_counts(spark, sf_dir):
    return route_counts(trips(spark, sf_dir))


def _q_frequent_routes_seasonal(spark, sf_dir):
    return frequent_routes_seasonal(trips(spark, sf_dir), SEASON_MONTH, SEASON_WEEKDAY, SEASON_HHMM)


def _q_frequent_routes_seasonal_compat(spark, sf_dir):
    return frequent_routes_seasonal(
        trips(spark, sf_dir), SEASON_MONTH, SEASON_WEEKDAY, SEASON_HHMM, compat=True
    )


def _q_time_of_day_wrap(spark, sf_dir):
    """Pickups per weekday in a band and in the band's complement written as a wrapped band."""
    t = trips(spark, sf_dir)
    lo, hi = band_before("09:50", 10)
    return t.groupBy(S.WEEKDAY).agg(
        F.count_if(in_time_of_day(S.PICKUP_TIME, lo, hi)).alias("n_banda"),
        F.count_if(in_time_of_day(S.PICKUP_TIME, hi, lo, wrap=True)).alias("n_banda_envuelta"),
        F.count_if(in_time_of_day(S.PICKUP_TIME, hi, lo, wrap=False)).alias("n_banda_sin_envolver"),
        F.count(F.lit(1)).alias("n"),
    )


def _q_last_dropoff_per_taxi(spark, sf_dir):
    return latest_per_key(
        trips(spark, sf_dir),
        key=(S.MEDALLION,),
        order=S.DROPOFF_TIME,
        payload=S.DROPOFF_CELL,
        tiebreak=TIEBREAK,
    )


def _instant(spark, sf_dir):
    return instant_query(trips(spark, sf_dir), AT, tiebreak=TIEBREAK)


def _q_taxi_state(spark, sf_dir):
    return with_in_use_flag(_instant(spark, sf_dir).state(), ts_literal(AT))


def _q_free_taxis_per_cell(spark, sf_dir):
    return free_taxis_per_cell(_instant(spark, sf_dir).cells())


def _q_area_benefit(spark, sf_dir):
    return area_benefit(_instant(spark, sf_dir).cells())


def _q_profitable_areas(spark, sf_dir):
    return profitable_areas(trips(spark, sf_dir), AT, tiebreak=TIEBREAK)


def _seasonal_cells(spark, sf_dir):
    return seasonal_query(trips(spark, sf_dir), AREA_WEEKDAY, AREA_MMDD, AREA_HHMM, tiebreak=TIEBREAK).cells()


def _q_weighted_free_taxis(spark, sf_dir):
    return weighted_free_taxis(_seasonal_cells(spark, sf_dir))


def _q_seasonal_area_benefit(spark, sf_dir):
    return seasonal_area_benefit(_seasonal_cells(spark, sf_dir))


def _q_seasonal_area_benefit_split(spark, sf_dir):
    return seasonal_area_benefit(_seasonal_cells(spark, sf_dir), split=True)


def _q_profitable_areas_seasonal(spark, sf_dir):
    return profitable_areas_seasonal(
        trips(spark, sf_dir), AREA_WEEKDAY, AREA_MMDD, AREA_HHMM, tiebreak=TIEBREAK
    )


def _q_profitable_areas_seasonal_compat(spark, sf_dir):
    return profitable_areas_seasonal(
        trips(spark, sf_dir), AREA_WEEKDAY, AREA_MMDD, AREA_HHMM, compat=True, tiebreak=TIEBREAK
    )


def _q_frequent_routes_b(spark, sf_dir):
    return frequent_routes(trips(spark, sf_dir), AT_B)


def _q_frequent_routes_seasonal_b(spark, sf_dir):
    return frequent_routes_seasonal(trips(spark, sf_dir), *SEASON_B)


def _q_profitable_areas_b(spark, sf_dir):
    return profitable_areas(trips(spark, sf_dir), AT_AREA_B, tiebreak=TIEBREAK)


def _q_profitable_areas_seasonal_b(spark, sf_dir):
    return profitable_areas_seasonal(trips(spark, sf_dir), *AREA_B, tiebreak=TIEBREAK)


def _q_profitable_areas_seasonal_b_compat(spark, sf_dir):
    return profitable_areas_seasonal(trips(spark, sf_dir), *AREA_B, compat=True, tiebreak=TIEBREAK)


def _q_result_line(spark, sf_dir):
    """The four result lines (elapsed time left out so they are deterministic)."""
    t = trips(spark, sf_dir)
    at = _dt.datetime.fromisoformat(AT)
    lo30 = at - _dt.timedelta(minutes=30)
    band_lo, band_hi = band_before(SEASON_HHMM, 30)
    area_ref = _dt.datetime.fromisoformat(f"2013-{AREA_MMDD} {AREA_HHMM}")
    lines = [
        route_line(frequent_routes(t, AT), "frequent_routes", lo30, at),
        route_line(
            frequent_routes_seasonal(t, SEASON_MONTH, SEASON_WEEKDAY, SEASON_HHMM),
            "frequent_routes_seasonal",
            band_lo,
            band_hi,
        ),
        area_line(profitable_areas(t, AT, tiebreak=TIEBREAK), "profitable_areas", lo30, at),
        area_line(
            profitable_areas_seasonal(t, AREA_WEEKDAY, AREA_MMDD, AREA_HHMM, tiebreak=TIEBREAK),
            "profitable_areas_seasonal",
            area_ref - _dt.timedelta(minutes=30),
            area_ref,
        ),
    ]
    out = lines[0]
    for line in lines[1:]:
        out = out.unionByName(line)
    return out


def _q_frequent_routes_by_instant(spark, sf_dir):
    """Top-10 routes at every 5-minute instant (the streaming query, run as a batch)."""
    from .streaming.routes_stream import rank_per_instant, route_counts_by_instant

    return rank_per_instant(route_counts_by_instant(trips(spark, sf_dir), 30, 5))


def _roundtrip_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        checksum("k").alias("sum_k"),
        F.sum((F.col(S.FARE) * 100).cast("bigint")).alias("sum_tarifa_c"),
        F.sum(S.PICKUP_LAT_CELL).alias("sum_cuad_latitud_subida"),
        F.sum(S.DROPOFF_LON_CELL).alias("sum_cuad_longitud_bajada"),
        F.sum(S.WEEKDAY).cast("bigint").alias("sum_dia_semana"),
        F.max(S.DROPOFF_TIME).alias("max_bajada"),
    )


def _q_roundtrip_parquet(spark, sf_dir):
    path = scratch_path(spark, "roundtrip-parquet")
    write_trips(trips(spark, sf_dir), path, layout="by_date")
    return _roundtrip_summary(read_trips(spark, path))


def _q_roundtrip_csv(spark, sf_dir):
    path = scratch_path(spark, "roundtrip-csv")
    write_trips_csv(trips(spark, sf_dir), path)
    return _roundtrip_summary(read_trips_csv(spark, path, extra=(("k", "bigint"),)))


def _q_scan_benchmark(spark, sf_dir):
    """Rows counted in the raw CSV and in its Parquet twin; the times go to the timing log."""
    scratch = scratch_path(spark, "scan")
    found = scan_benchmark(spark, _raw_csv(spark, sf_dir), f"{scratch}/parquet", timing_path=f"{scratch}/timings")
    return found.select("formato", "filas")


MIDNIGHT_ROUTES = ("marzo", "martes", "00:15")
MIDNIGHT_AREAS = ("martes", "03-01", "00:15")


def _q_routes_midnight(spark, sf_dir):
    return frequent_routes_seasonal(trips(spark, sf_dir), *MIDNIGHT_ROUTES)


def _q_routes_midnight_compat(spark, sf_dir):
    return frequent_routes_seasonal(trips(spark, sf_dir), *MIDNIGHT_ROUTES, compat=True)


def _q_areas_midnight(spark, sf_dir):
    return profitable_areas_seasonal(trips(spark, sf_dir), *MIDNIGHT_AREAS, tiebreak=TIEBREAK)


def _q_areas_midnight_compat(spark, sf_dir):
    return profitable_areas_seasonal(trips(spark, sf_dir), *MIDNIGHT_AREAS, compat=True, tiebreak=TIEBREAK)


def _stored(spark, sf_dir):
    """The processed table in the date layout, read through its file index."""
    path = scratch_path(spark, "stored")
    write_trips(trips(spark, sf_dir), path, layout="by_date", rows_per_file=STORED_ROWS)
    return open_trips(spark, path)


def _q_stored_frequent_routes(spark, sf_dir):
    return frequent_routes(_stored(spark, sf_dir), AT)


def _q_stored_frequent_routes_seasonal(spark, sf_dir):
    return frequent_routes_seasonal(_stored(spark, sf_dir), SEASON_MONTH, SEASON_WEEKDAY, SEASON_HHMM)


def _q_stored_profitable_areas(spark, sf_dir):
    return profitable_areas(_stored(spark, sf_dir), AT, tiebreak=TIEBREAK)


def _q_stored_profitable_areas_seasonal(spark, sf_dir):
    return profitable_areas_seasonal(_stored(spark, sf_dir), AREA_WEEKDAY, AREA_MMDD, AREA_HHMM, tiebreak=TIEBREAK)


def _q_stored_routes_midnight(spark, sf_dir):
    return frequent_routes_seasonal(_stored(spark, sf_dir), *MIDNIGHT_ROUTES)


def _q_stored_areas_midnight(spark, sf_dir):
    return profitable_areas_seasonal(_stored(spark, sf_dir), *MIDNIGHT_AREAS, tiebreak=TIEBREAK)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "raw_trips_profile": _q_raw_profile,
        "clean_trips": _q_clean_trips,
        "clean_report": _q_clean_report,
        "clean_report_compat": _q_clean_report_compat,
        "clean_report_any_differs": _q_clean_report_any_differs,
        "trip_cells": _q_trip_cells,
        "grid_cells": _q_grid_cells,
        "process_csv": _q_process_csv,
        "prefix_sample": _q_prefix_sample,
        "prefix_sample_large": _q_prefix_sample_large,
        "size_ladder": _q_size_ladder,
        "frequent_routes": _q_frequent_routes,
        "route_counts": _q_route_counts,
        "frequent_routes_seasonal": _q_frequent_routes_seasonal,
        "frequent_routes_seasonal_compat": _q_frequent_routes_seasonal_compat,
        "time_of_day_wrap": _q_time_of_day_wrap,
        "frequent_routes_by_instant": _q_frequent_routes_by_instant,
        "last_dropoff_per_taxi": _q_last_dropoff_per_taxi,
        "taxi_state": _q_taxi_state,
        "free_taxis_per_cell": _q_free_taxis_per_cell,
        "area_benefit": _q_area_benefit,
        "profitable_areas": _q_profitable_areas,
        "weighted_free_taxis": _q_weighted_free_taxis,
        "seasonal_area_benefit": _q_seasonal_area_benefit,
        "seasonal_area_benefit_split": _q_seasonal_area_benefit_split,
        "profitable_areas_seasonal": _q_profitable_areas_seasonal,
        "profitable_areas_seasonal_compat": _q_profitable_areas_seasonal_compat,
        "frequent_routes_b": _q_frequent_routes_b,
        "frequent_routes_seasonal_b": _q_frequent_routes_seasonal_b,
        "profitable_areas_b": _q_profitable_areas_b,
        "profitable_areas_seasonal_b": _q_profitable_areas_seasonal_b,
        "profitable_areas_seasonal_b_compat": _q_profitable_areas_seasonal_b_compat,
        "frequent_routes_seasonal_midnight": _q_routes_midnight,
        "frequent_routes_seasonal_midnight_compat": _q_routes_midnight_compat,
        "profitable_areas_seasonal_midnight": _q_areas_midnight,
        "profitable_areas_seasonal_midnight_compat": _q_areas_midnight_compat,
        "stored_frequent_routes": _q_stored_frequent_routes,
        "stored_frequent_routes_seasonal": _q_stored_frequent_routes_seasonal,
        "stored_profitable_areas": _q_stored_profitable_areas,
        "stored_profitable_areas_seasonal": _q_stored_profitable_areas_seasonal,
        "stored_frequent_routes_seasonal_midnight": _q_stored_routes_midnight,
        "stored_profitable_areas_seasonal_midnight": _q_stored_areas_midnight,
        "file_index": _q_file_index,
        "compacted_trips": _q_compacted,
        "profitable_areas_packed": _q_areas_packed,
        "profitable_areas_seasonal_packed": _q_areas_seasonal_packed,
        "stored_profitable_areas_seasonal_midnight_packed": _q_areas_midnight_packed,
        "route_rollup": _q_route_rollup,
        "rollup_frequent_routes_seasonal": _q_rollup_routes,
        "rollup_frequent_routes_seasonal_b": _q_rollup_routes_b,
        "rollup_frequent_routes_seasonal_midnight": _q_rollup_routes_midnight,
        "quarantine_report": _q_quarantine_report,
        "quarantine_fields": _q_quarantine_fields,
        "quarantine_process": _q_quarantine_process,
        "prefix_null_tail": _q_prefix_null_tail,
        "prefix_hot_second": _q_prefix_hot_second,
        "result_line": _q_result_line,
        "roundtrip_parquet": _q_roundtrip_parquet,
        "roundtrip_csv": _q_roundtrip_csv,
        "scan_benchmark": _q_scan_benchmark,
    }
