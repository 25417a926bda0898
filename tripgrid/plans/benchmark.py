"""Job runs with timing, the CSV-vs-Parquet scan benchmark and the performance summary."""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..operators.clean import process_trips, quarantine, well_formed
from ..sources.trips_io import append_timing, read_raw_trips, session_cores, write_trips

SCAN_SCHEMA = T.StructType(
    [
        T.StructField("formato", T.StringType(), False),
        T.StructField("filas", T.LongType(), False),
        T.StructField("segundos", T.DoubleType(), False),
        T.StructField("filas_por_segundo", T.DoubleType(), True),
    ]
)


def run_process(
    spark: SparkSession,
    csv_path: str,
    out_path: str,
    timing_path: str | None = None,
    mode: str = "errorifexists",
    layout: str = "by_date",
    compat: bool = False,
    label: str | None = None,
    cluster: str = "counts",
    quarantine_path: str | None = None,
) -> float:
    """Clean + enrich + store one raw CSV log; returns (and optionally logs) the seconds taken.

    ``quarantine_path`` gets the malformed records (line and wrong fields, as
    Parquet); without it they are cleaned as rows with NULL fields. They are
    counted while the log is read, and looked up only if there are any.

    The log gets the raw rows read (counted while they pass), the session's
    cores and ``label``, the input path unless given, so that runs over one
    input group.
    """
    start = time.perf_counter()
    counted = Observation("procesamiento")
    raw = read_raw_trips(spark, csv_path, rescue=quarantine_path is not None)
    seen = raw.observe(counted, F.count(F.lit(1)).alias("filas"), F.count_if(~well_formed(raw)).alias("malos"))
    write_trips(process_trips(seen, compat=compat), out_path, mode=mode, layout=layout, cluster=cluster)
    if quarantine_path and counted.get["malos"]:
        quarantine(raw).write.mode(mode).parquet(quarantine_path)
    seconds = time.perf_counter() - start
    if timing_path:
        append_timing(
            spark, timing_path, "procesamiento", seconds, counted.get["filas"], session_cores(spark), label or csv_path
        )
    return seconds


def _timed_count(df: DataFrame) -> tuple[int, float]:
    start = time.perf_counter()
    n = df.count()
    return n, time.perf_counter() - start


def scan_benchmark(
    spark: SparkSession, csv_path: str, parquet_path: str, schema: T.StructType = S.RAW_SCHEMA, timing_path: str | None = None
) -> DataFrame:
    """Time a full ``count(*)`` of a raw CSV log and of its Snappy Parquet twin.

    The given files are counted as they are; the twin is written first if
    there is none. Returns rows (formato, filas, segundos, filas_por_segundo);
    ``timing_path`` also gets them as timing rows.
    """
    try:
        twin = spark.read.parquet(parquet_path)
    except AnalysisException:
        read_raw_trips(spark, csv_path, schema=schema).write.option("compression", "snappy").parquet(parquet_path)
        twin = spark.read.parquet(parquet_path)
    rows = []
    for fmt, df in (("csv", read_raw_trips(spark, csv_path, schema=schema)), ("parquet", twin)):
        n, secs = _timed_count(df)
        rows.append((fmt, n, secs, n / secs if secs > 0 else None))
        if timing_path:
            append_timing(spark, timing_path, f"conteo_{fmt}", secs, n, session_cores(spark), csv_path)
    return spark.createDataFrame(rows, SCAN_SCHEMA)


def performance_summary(timings: DataFrame) -> DataFrame:
    """Per (trabajo, etiqueta, nucleos): runs, mean seconds, rows,
    speed = rows / mean seconds and efficiency = speed / cores."""
    return (
        timings.groupBy("trabajo", "etiqueta", "nucleos")
        .agg(
            F.count(F.lit(1)).alias("ejecuciones"),
            F.avg("segundos").alias("segundos_medios"),
            F.max("filas").alias("filas"),
        )
        .withColumn("velocidad", F.try_divide(F.col("filas").cast("double"), F.col("segundos_medios")))
        .withColumn("eficiencia", F.try_divide(F.col("velocidad"), F.col("nucleos").cast("double")))
    )
