"""Cleaning and enrichment of the raw trip log.

``clean_trips`` keeps the 13 useful columns of rows that pass every rule;
``enrich`` adds the four grid cells and the weekday; ``process_trips`` is both.
All rules are one ``where`` of native predicates (Catalyst merges them into a
single filter inside the scan stage); no shuffle is involved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.grid import (
    FAR_LATITUDE,
    FAR_LONGITUDE,
    GRID_SIZE,
    ORIGIN_LATITUDE,
    ORIGIN_LONGITUDE,
    in_grid,
    lat_cell,
    lon_cell,
)
from ..functions.time import weekday0

# Fixed value: payment codes the original cleaning keeps (cash, card).
PAYMENT_CODES = ("CSH", "CRD")


def valid_ids() -> Column:
    """Taxi and licence ids are present and non-empty (NULL fails too)."""
    return (F.col(S.MEDALLION) != "") & (F.col(S.LICENSE) != "")


def valid_times() -> Column:
    """Pickup and drop-off times differ."""
    return F.col(S.PICKUP_TIME) != F.col(S.DROPOFF_TIME)


def positive() -> Column:
    """Trip duration and total amount are strictly positive."""
    return (F.col(S.DURATION) > 0) & (F.col(S.TOTAL) > 0)


def moved(mode: str = "both_differ") -> Column:
    """The trip changed position.

    ``both_differ`` (the original rule) needs both longitude and latitude to
    differ, so due-north and due-east trips are dropped; ``any_differs`` keeps
    them and only drops trips whose two coordinates are both unchanged.
    """
    lon = F.col(S.PICKUP_LON) != F.col(S.DROPOFF_LON)
    lat = F.col(S.PICKUP_LAT) != F.col(S.DROPOFF_LAT)
    if mode == "both_differ":
        return lon & lat
    if mode == "any_differs":
        return lon | lat
    raise ValueError(f"mode must be both_differ or any_differs, got {mode!r}")


def valid_payment(codes: Sequence[str] = PAYMENT_CODES) -> Column:
    return F.col(S.PAYMENT).isin(list(codes))


def in_box() -> Column:
    """Both trip ends inside the grid's bounding box, edges included.

    Coordinates are compared as doubles, like the grid arithmetic.
    """
    cond = F.lit(True)
    for lon, lat in ((S.PICKUP_LON, S.PICKUP_LAT), (S.DROPOFF_LON, S.DROPOFF_LAT)):
        lon_d = F.col(lon).cast("double")
        lat_d = F.col(lat).cast("double")
        cond = (
            cond
            & (lon_d >= F.lit(ORIGIN_LONGITUDE))
            & (lon_d <= F.lit(FAR_LONGITUDE))
            & (lat_d >= F.lit(FAR_LATITUDE))
            & (lat_d <= F.lit(ORIGIN_LATITUDE))
        )
    return cond


def cleaning_rules(moved_mode: str = "both_differ") -> dict[str, Column]:
    """Every cleaning rule by name, in the order the original applies them."""
    return {
        "ids": valid_ids(),
        "times": valid_times(),
        "positive": positive(),
        "moved": moved(moved_mode),
        "payment": valid_payment(),
        "box": in_box(),
    }


def grid_rule() -> Column:
    """Both trip ends in a cell of 1..300 (the far box edges fall into cell 301)."""
    return in_grid(
        lat_cell(S.PICKUP_LAT), lon_cell(S.PICKUP_LON), lat_cell(S.DROPOFF_LAT), lon_cell(S.DROPOFF_LON), size=GRID_SIZE
    )


def cleaning_rule(moved_mode: str = "both_differ") -> Column:
    cond = F.lit(True)
    for rule in cleaning_rules(moved_mode).values():
        cond = cond & rule
    return cond


def well_formed(raw: DataFrame) -> Column:
    """Records that fit the schema; all of them where the log was read without a rescue column."""
    return F.col(S.RESCUE).isNull() if S.RESCUE in raw.columns else F.lit(True)


WRONG_COUNT = "numero_de_campos"


def quarantine(raw: DataFrame, schema: T.StructType = S.RAW_SCHEMA) -> DataFrame:
    """Malformed records of a log read with ``rescue``: the line, and ``campos``, what is wrong with it.

    ``campos`` names the fields whose text is not empty and was not understood,
    and ``numero_de_campos`` where the record has too few or too many fields
    (told from the commas of records without quotes).
    """
    texts = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    text = F.from_csv(F.col(S.RESCUE), texts.simpleString()[len("struct<") : -1].replace(":", " "))
    bad = [F.when((F.coalesce(F.col(f"_text.{c}"), F.lit("")) != "") & F.col(c).isNull(), F.lit(c)) for c in texts.names]
    commas = F.length(S.RESCUE) - F.length(F.replace(F.col(S.RESCUE), F.lit(","), F.lit("")))
    bad.append(F.when(~F.contains(F.col(S.RESCUE), F.lit('"')) & (commas != len(texts) - 1), F.lit(WRONG_COUNT)))
    rows = raw.where(F.col(S.RESCUE).isNotNull()).withColumn("_text", text)
    return rows.select(S.RESCUE, F.array_compact(F.array(*bad)).alias("campos"))


def malformed_report(quarantined: DataFrame) -> DataFrame:
    """Malformed records by what is wrong with them (a record may count for several): campo, registros."""
    return quarantined.select(F.explode("campos").alias("campo")).groupBy("campo").agg(F.count(F.lit(1)).alias("registros"))


def clean_trips(
    raw: DataFrame, moved_mode: str = "both_differ", extra: Sequence[str] = ()
) -> DataFrame:
    """Rows passing every rule, projected to the 13 kept columns (+ ``extra``); malformed records are left out."""
    raw = raw.where(well_formed(raw)) if S.RESCUE in raw.columns else raw
    return raw.where(cleaning_rule(moved_mode)).select(*S.KEPT_COLUMNS, *extra)


def enrich(clean: DataFrame, compat: bool = False) -> DataFrame:
    """Add grid cells and weekday (Monday = 0).

    A trip exactly on the far box edge gets cell 301 from the double arithmetic;
    by default such rows are dropped so every cell is in 1..300. ``compat``
    keeps them, as the original did.
    """
    out = clean.withColumns(
        {
            S.PICKUP_LAT_CELL: lat_cell(S.PICKUP_LAT),
            S.PICKUP_LON_CELL: lon_cell(S.PICKUP_LON),
            S.DROPOFF_LAT_CELL: lat_cell(S.DROPOFF_LAT),
            S.DROPOFF_LON_CELL: lon_cell(S.DROPOFF_LON),
            S.WEEKDAY: weekday0(S.PICKUP_TIME),
        }
    )
    if not compat:
        out = out.where(
            in_grid(
                S.PICKUP_LAT_CELL,
                S.PICKUP_LON_CELL,
                S.DROPOFF_LAT_CELL,
                S.DROPOFF_LON_CELL,
                size=GRID_SIZE,
            )
        )
    return out


def process_trips(
    raw: DataFrame,
    compat: bool = False,
    moved_mode: str = "both_differ",
    extra: Sequence[str] = (),
) -> DataFrame:
    """Clean + enrich: the processed trip table (13 kept + 5 derived columns)."""
    return enrich(clean_trips(raw, moved_mode, extra), compat=compat)


def clean_report(raw: DataFrame, moved_mode: str = "both_differ", compat: bool = False) -> DataFrame:
    """One row: raw count, rows failing each rule (a row may fail several), rows the job writes.

    ``n_clean`` is the row count of ``process_trips`` with the same options:
    the rule ``grid`` decides too, unless ``compat`` keeps the far box edge.
    For a log read with ``rescue`` there are two more counts, and the failures
    are those of well-formed records: ``n_raw = n_malformed + n_rejected + n_clean``.
    One pass, one global aggregate (partial per task, final over one row per task).
    """
    rules = cleaning_rules(moved_mode) | {"grid": grid_rule()}
    kept = cleaning_rule(moved_mode) if compat else cleaning_rule(moved_mode) & rules["grid"]
    kept, fits = F.coalesce(kept, F.lit(False)), well_formed(raw)
    aggs = [F.count(F.lit(1)).alias("n_raw")]
    if S.RESCUE in raw.columns:
        aggs += [F.count_if(~fits).alias("n_malformed"), F.count_if(fits & ~kept).alias("n_rejected")]
    for name, rule in rules.items():
        # A NULL comparison removes the row in WHERE, so it counts as a failure.
        aggs.append(F.count_if(fits & ~F.coalesce(rule, F.lit(False))).alias(f"fail_{name}"))
    aggs.append(F.count_if(fits & kept).alias("n_clean"))
    return raw.agg(*aggs)
