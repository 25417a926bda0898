"""A raw trip log derived from the driver's ``lineitem`` table.

No trip table ships with the test data, so one is derived row by row from
``lineitem`` with integer arithmetic only (the DuckDB oracle does the same in
SQL). Every lineitem row becomes one raw trip; the work grows with the table.

``k`` (a per-row integer) is kept as an extra column and used as tie-break.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S

# Fixed values of the fixture (FIXTURES.md section 6): start instant, first
# second of the day (09:15:00), grid origin and cell steps of the coordinates.
_EPOCH = "2013-01-01 00:00:00"
_DAY_SECONDS = 86400
_FIRST_SECOND = 33300
_ORIGIN_LON = Decimal("-74.916578")
_ORIGIN_LAT = Decimal("41.477182778")
_LON_STEP = Decimal("0.005986")
_LAT_STEP = Decimal("0.004491556")
_FAR_LON = Decimal("-73.120778")
_FAR_LAT = Decimal("40.129715978")
_HALF = Decimal("0.5")
_CENT = Decimal("0.01")


def raw_trips_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """The 17 raw columns (``RAW_SCHEMA`` types) plus ``k``."""
    k = F.col("k")

    def d(n: int) -> Column:
        # Exact integer division (floor(k / n) in double would round for large k).
        return F.expr(f"k div {n}")

    wide = d(11) % 5 == 0

    def cell(base: int, a: int, b: int, c: int) -> Column:
        # Most trips in 5 x 5 cells, so that cells hold several; a fifth all over the grid.
        return F.when(wide, d(a) % 300 + 1).otherwise(F.lit(base) + F.least(d(a) % 5, d(b) % 5, d(c) % 5))

    def coord(origin: Decimal, step: Decimal, cell_col: Column, sign: int) -> Column:
        # Exact decimal arithmetic: the centre of the cell.
        centre = (cell_col.cast("decimal(20,0)") - F.lit(_HALF)) * F.lit(sign * step)
        return (F.lit(origin) + centre).cast("decimal(18,14)")

    def at_edge(every: int, edge: Decimal, otherwise: Column) -> Column:
        return F.when(k % every == 0, F.lit(edge).cast("decimal(18,14)")).otherwise(otherwise)

    with_k = lineitem.select(
        (
            F.col("l_orderkey") * 1000003
            + F.col("l_partkey") * 8191
            + F.col("l_suppkey") * 131
            + F.col("l_linenumber")
        ).alias("k"),
        "l_suppkey",
        "l_partkey",
    )
    second = F.when(d(5) % 4 == 0, d(672) % _DAY_SECONDS).otherwise(_FIRST_SECOND + d(672) % 3600)
    cells = with_k.select(
        "*",
        cell(150, 13, 37, 483).alias("_a"),
        cell(155, 17, 41, 699).alias("_b"),
        cell(150, 29, 43, 1249).alias("_c"),
        cell(155, 31, 47, 1459).alias("_d"),
        (d(8) % 84 * _DAY_SECONDS + second).alias("_start"),
        (d(7) % 900).cast("int").alias("_dur"),
        (250 + d(19) % 5000).alias("_fare"),
        (d(23) % 1000).alias("_tip"),
    )
    epoch = F.lit(_EPOCH).cast("timestamp_ntz")
    pickup = F.timestamp_add("SECOND", F.col("_start"), epoch)
    money = lambda c: (c.cast("decimal(20,0)") * F.lit(_CENT)).cast("decimal(10,2)")
    pickup_lon = at_edge(61, _FAR_LON, coord(_ORIGIN_LON, _LON_STEP, F.col("_a"), +1))
    return cells.select(
        F.when(k % 97 == 0, F.lit(""))
        .when(k % 89 != 0, F.concat(F.lit("T"), F.col("l_suppkey").cast("string")))
        .alias(S.MEDALLION),
        F.when(k % 83 == 0, F.lit("")).otherwise(F.concat(F.lit("L"), F.col("l_partkey").cast("string"))).alias(S.LICENSE),
        pickup.alias(S.PICKUP_TIME),
        F.when(k % 103 != 0, F.timestamp_add("SECOND", F.col("_dur"), pickup)).alias(S.DROPOFF_TIME),
        F.col("_dur").alias(S.DURATION),
        F.lit(Decimal("1.00")).cast("decimal(10,2)").alias(S.DISTANCE),
        F.when(k % 53 == 0, F.lit(0).cast("decimal(18,14)")).otherwise(pickup_lon).alias(S.PICKUP_LON),
        at_edge(71, _FAR_LAT, coord(_ORIGIN_LAT, _LAT_STEP, F.col("_b"), -1)).alias(S.PICKUP_LAT),
        at_edge(73, _ORIGIN_LON, coord(_ORIGIN_LON, _LON_STEP, F.col("_c"), +1)).alias(S.DROPOFF_LON),
        at_edge(67, _ORIGIN_LAT, coord(_ORIGIN_LAT, _LAT_STEP, F.col("_d"), -1)).alias(S.DROPOFF_LAT),
        F.when(k % 79 != 0, F.when(k % 10 == 0, F.lit("UNK")).when(k % 10 < 5, F.lit("CSH")).otherwise(F.lit("CRD"))).alias(
            S.PAYMENT
        ),
        money(F.col("_fare")).alias(S.FARE),
        F.lit(Decimal("0.50")).cast("decimal(10,2)").alias(S.SURCHARGE),
        F.lit(Decimal("0.50")).cast("decimal(10,2)").alias(S.TAX),
        money(F.col("_tip")).alias(S.TIP),
        F.lit(Decimal("0.00")).cast("decimal(10,2)").alias(S.TOLLS),
        money(F.when(k % 101 == 0, F.lit(0).cast("bigint")).otherwise(F.col("_fare") + F.col("_tip"))).alias(S.TOTAL),
        k,
    )


def computed_once(raw: DataFrame) -> DataFrame:
    """The same rows, with every column computed once a row.

    The optimizer moves a filter below the columns it tests and puts their
    formulas in its place, one evaluation for every mention; the cleaning rules
    mention each coordinate a dozen times. Columns that a generator gives out
    are values to the filters above it.
    """
    return raw.select(F.inline(F.array(F.struct(*raw.columns))))


def read_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trip log derived from ``{sf_dir}/lineitem.parquet`` (lazy: every query derives it from the table)."""
    return raw_trips_from_lineitem(read_lineitem(spark, sf_dir))
