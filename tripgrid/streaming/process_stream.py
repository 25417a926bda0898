"""Incremental clean + enrich + store of a growing raw log (Structured Streaming).

The batch job reprocesses a whole CSV log; here new CSV files dropped into a
directory are processed as they arrive, with exactly-once output through the
file sink's commit log and the query checkpoint (both survive executor and
driver loss). The transformation is the same ``process_trips`` plan:
stateless, so no watermark or state store is needed.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import schema as S
from ..operators.clean import process_trips
from ..sources.trips_io import with_layout_columns


def read_raw_stream(spark: SparkSession, raw_dir: str, max_files_per_trigger: int | None = None):
    reader = (
        spark.readStream.schema(S.RAW_SCHEMA)
        .option("header", "false")
        .option("timestampFormat", S.TIME_FORMAT)
        .option("timestampNTZFormat", S.TIME_FORMAT)
        .option("mode", "PERMISSIVE")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(raw_dir)


def process_stream(
    spark: SparkSession,
    raw_dir: str,
    out_path: str,
    checkpoint_location: str | None = None,
    layout: str = "by_date",
    available_now: bool = True,
    processing_time: str | None = None,
    compat: bool = False,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the streaming job; returns the running query.

    ``available_now`` processes every file present and stops (the incremental
    batch mode); otherwise it keeps running with ``processing_time`` triggers.
    The checkpoint belongs to the output: by default it is ``_checkpoint`` inside
    ``out_path`` (hidden from readers), so a later call with the same output
    goes on where the last one ended.
    ``max_files_per_trigger`` bounds each micro-batch when a backlog arrives.
    """
    trips = process_trips(read_raw_stream(spark, raw_dir, max_files_per_trigger), compat=compat)
    writer_df = with_layout_columns(trips) if layout == "by_date" else trips
    writer = (
        writer_df.writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint_location or f"{out_path.rstrip('/')}/_checkpoint")
        .option("compression", "snappy")
        .outputMode("append")
    )
    if layout == "by_date":
        writer = writer.partitionBy(S.PICKUP_DATE, S.DROPOFF_DATE)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
