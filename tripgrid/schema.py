"""Column names and schemas of the trip log.

Column names are the ones a user of the original application already has in
their files, so existing CSV logs and processed Parquet tables load unchanged.
Times are ``TIMESTAMP_NTZ``: trip times carry no zone, and a session-zone
timestamp would break on the daylight-saving gap.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Raw columns, in file order.
MEDALLION = "medallon"
LICENSE = "licencia"
PICKUP_TIME = "hora_subida"
DROPOFF_TIME = "hora_bajada"
DURATION = "duracion_viaje_seg"
DISTANCE = "distancia_viaje"
PICKUP_LON = "longitud_subida"
PICKUP_LAT = "latitud_subida"
DROPOFF_LON = "longitud_bajada"
DROPOFF_LAT = "latitud_bajada"
PAYMENT = "tipo_pago"
FARE = "tarifa"
SURCHARGE = "recargo"
TAX = "tasas"
TIP = "propina"
TOLLS = "peaje"
TOTAL = "cantidad_total"

# Derived columns of the processed table.
PICKUP_LAT_CELL = "cuad_latitud_subida"
PICKUP_LON_CELL = "cuad_longitud_subida"
DROPOFF_LAT_CELL = "cuad_latitud_bajada"
DROPOFF_LON_CELL = "cuad_longitud_bajada"
WEEKDAY = "dia_semana"

# Optional storage columns of the "by_date" layout: pickup and drop-off dates
# (Parquet partition keys) and seconds since midnight of both times (stored so
# time-of-day bands reach the Parquet reader as plain range filters).
PICKUP_DATE = "fecha_subida"
DROPOFF_DATE = "fecha_bajada"
PICKUP_SECOND = "segundo_subida"
DROPOFF_SECOND = "segundo_bajada"
LAYOUT_COLUMNS = (PICKUP_DATE, DROPOFF_DATE, PICKUP_SECOND, DROPOFF_SECOND)

# Raw reads with a rescue column: the line of a record that does not fit the schema.
RESCUE = "registro_malo"

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

_MONEY = T.DecimalType(10, 2)
_COORD = T.DecimalType(18, 14)

RAW_SCHEMA = T.StructType(
    [
        T.StructField(MEDALLION, T.StringType(), True),
        T.StructField(LICENSE, T.StringType(), True),
        T.StructField(PICKUP_TIME, T.TimestampNTZType(), True),
        T.StructField(DROPOFF_TIME, T.TimestampNTZType(), True),
        T.StructField(DURATION, T.IntegerType(), True),
        T.StructField(DISTANCE, _MONEY, True),
        T.StructField(PICKUP_LON, _COORD, True),
        T.StructField(PICKUP_LAT, _COORD, True),
        T.StructField(DROPOFF_LON, _COORD, True),
        T.StructField(DROPOFF_LAT, _COORD, True),
        T.StructField(PAYMENT, T.StringType(), True),
        T.StructField(FARE, _MONEY, True),
        T.StructField(SURCHARGE, _MONEY, True),
        T.StructField(TAX, _MONEY, True),
        T.StructField(TIP, _MONEY, True),
        T.StructField(TOLLS, _MONEY, True),
        T.StructField(TOTAL, _MONEY, True),
    ]
)

# The 13 raw columns the processed table keeps.
KEPT_COLUMNS = (
    MEDALLION,
    LICENSE,
    PICKUP_TIME,
    DROPOFF_TIME,
    DURATION,
    PICKUP_LON,
    PICKUP_LAT,
    DROPOFF_LON,
    DROPOFF_LAT,
    PAYMENT,
    FARE,
    TIP,
    TOTAL,
)

DERIVED_COLUMNS = (
    PICKUP_LAT_CELL,
    PICKUP_LON_CELL,
    DROPOFF_LAT_CELL,
    DROPOFF_LON_CELL,
    WEEKDAY,
)

PROCESSED_COLUMNS = KEPT_COLUMNS + DERIVED_COLUMNS

# A route is (pickup cell, drop-off cell), longitude cell first.
ROUTE = (PICKUP_LON_CELL, PICKUP_LAT_CELL, DROPOFF_LON_CELL, DROPOFF_LAT_CELL)
# An area is one cell, latitude cell first (the order profitable-area results use).
PICKUP_CELL = (PICKUP_LAT_CELL, PICKUP_LON_CELL)
DROPOFF_CELL = (DROPOFF_LAT_CELL, DROPOFF_LON_CELL)
AREA = ("cuad_latitud", "cuad_longitud")

# Processed table: kept raw columns + cells (bigint) + weekday (int).
PROCESSED_SCHEMA = T.StructType(
    [f for f in RAW_SCHEMA.fields if f.name in KEPT_COLUMNS]
    + [
        T.StructField(PICKUP_LAT_CELL, T.LongType(), True),
        T.StructField(PICKUP_LON_CELL, T.LongType(), True),
        T.StructField(DROPOFF_LAT_CELL, T.LongType(), True),
        T.StructField(DROPOFF_LON_CELL, T.LongType(), True),
        T.StructField(WEEKDAY, T.IntegerType(), True),
    ]
)
