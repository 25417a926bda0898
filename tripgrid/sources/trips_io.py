"""Sources and sinks of the trip log.

* raw log: headerless CSV read with the declared schema (never inferred);
* processed table: Snappy Parquet. The ``by_date`` layout partitions by
  pickup and drop-off date and writes files sorted by pickup time, a busy date
  cut into pieces of the day, with an index of the files (``trip_store``), so
  time-window queries open few files and skip row groups by their min/max
  statistics;
* processed rows as CSV;
* result lines and timing rows, appended.

Paths are any Hadoop file-system URI (local, HDFS, object stores).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..session import checkpoint_dir, delete_paths, ensure_checkpoint_dir, file_system, scratch_path
from .trip_store import Trips, TripStore, index_trips


def read_raw_trips(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = S.RAW_SCHEMA,
    mode: str = "PERMISSIVE",
    rescue: bool = False,
) -> DataFrame:
    """Headerless CSV with the declared raw schema.

    Empty or unparsable fields become NULL (``PERMISSIVE``), which the
    cleaning rules then remove. With ``rescue`` a further column, ``RESCUE``,
    holds the whole line of every record that has an unparsable field or
    another number of fields, and NULL for the others; ``clean_trips`` leaves
    such records out and ``quarantine`` gives them back.
    """
    reader = (
        spark.read.option("header", "false")
        .option("timestampFormat", S.TIME_FORMAT)
        .option("timestampNTZFormat", S.TIME_FORMAT)
        .option("mode", mode)
    )
    if not rescue:
        return reader.schema(schema).csv(path)
    with_line = T.StructType([*schema.fields, T.StructField(S.RESCUE, T.StringType(), True)])
    raw = reader.option("columnNameOfCorruptRecord", S.RESCUE).schema(with_line).csv(path)
    # Spark parses the columns that a query reads. Every field takes part here (the
    # comparison always holds), so what is malformed does not depend on the query.
    every_field = F.xxhash64(*schema.names) >= F.lit(-(1 << 63))
    return raw.withColumn(S.RESCUE, F.when(every_field, F.col(S.RESCUE)))


def register_trips(df: DataFrame, name: str = "unprocessed") -> DataFrame:
    """Expose ``df`` to ``spark.sql`` under ``name``."""
    df.createOrReplaceTempView(name)
    return df


def read_trips(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Processed Parquet table by path (layout columns included when present).

    This lists every file of the table; :func:`open_trips` opens those that a
    query needs.
    """
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.parquet(*paths)


def open_trips(spark: SparkSession, path: str) -> Trips:
    """The table at ``path`` for the queries: by its file index if it has one, else as a frame."""
    try:
        return TripStore(spark, path)
    except FileNotFoundError:
        return read_trips(spark, path)


def read_trips_table(spark: SparkSession, table: str) -> DataFrame:
    """Processed trips from a catalog table.

    With a metastore-backed catalog, partition filters are answered by the
    metastore, so only the files of the selected dates are ever listed.
    """
    return spark.table(table)


def with_layout_columns(df: DataFrame) -> DataFrame:
    """Add the "by_date" storage columns: pickup/drop-off date and second of day."""
    return df.withColumns(
        {
            S.PICKUP_DATE: F.to_date(S.PICKUP_TIME),
            S.DROPOFF_DATE: F.to_date(S.DROPOFF_TIME),
            S.PICKUP_SECOND: _second_of_day(S.PICKUP_TIME),
            S.DROPOFF_SECOND: _second_of_day(S.DROPOFF_TIME),
        }
    )


def _second_of_day(c: str):
    return (F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)).cast("int")


# Width of the pickup-time slots in which a date's rows are counted.
SLOT_SECONDS = 900
# Bytes of a row in a shuffle, about; files hold what fits in one shuffle partition.
ROW_BYTES = 160

LAYOUTS = ("flat", "by_date")
CLUSTERINGS = ("counts", "rebalance", "local")
# Tasks that write a load of many small files, for each core of the session.
_TASKS_PER_CORE = 4
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def _slot():
    return F.floor(F.col(S.PICKUP_SECOND) / SLOT_SECONDS).cast("int")


def rows_per_piece(spark: SparkSession) -> int:
    """Rows of a file unless a caller says otherwise: what fits in a shuffle partition of the advised size."""
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_ADVISORY, "64m"))
    return max(1, int(size) // ROW_BYTES)


def date_pieces(trips: DataFrame, rows_per_file: int) -> DataFrame:
    """``(fecha_subida, _slot, _pieza, _partes)`` of the dates with more rows than a file holds.

    A date's quarter hours are counted; the running count cuts the day into
    pieces of about ``rows_per_file`` rows; a quarter hour with more rows than
    that is dealt to several parts. Other dates are not listed: they stay in
    one piece. The result has at most 96 rows for each such date.
    """
    counted = trips.groupBy(S.PICKUP_DATE, _slot().alias("_slot")).agg(F.count(F.lit(1)).alias("n"))
    day = Window.partitionBy(S.PICKUP_DATE)  # at most 96 rows
    running = F.sum("n").over(day.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1))
    cut = counted.withColumns({"_total": F.sum("n").over(day), "_before": F.coalesce(running, F.lit(0).cast("bigint"))})
    piece = F.floor(F.col("_before") / rows_per_file).cast("int")
    parts = F.ceil(F.col("n") / rows_per_file).cast("int")
    return cut.where(F.col("_total") > rows_per_file).select(S.PICKUP_DATE, "_slot", piece.alias("_pieza"), parts.alias("_partes"))


def _with_pieces(trips: DataFrame, rows_per_file: int, scratch: list[str]) -> DataFrame:
    spark = trips.sparkSession
    if checkpoint_dir(spark) or spark.sparkContext.master.startswith("local"):
        # Cleaned rows are stored first, so a raw log is parsed once and the counts read one date and one time column.
        ensure_checkpoint_dir(spark)
        path = scratch_path(spark, "load")
        scratch.append(path)
        trips.write.parquet(path)
        trips = spark.read.schema(trips.schema).parquet(path)
    pieces = date_pieces(trips, rows_per_file)
    if checkpoint_dir(spark):
        path = scratch_path(spark, "pieces")
        scratch.append(path)
        pieces.write.parquet(path)  # its size is known from here on: Spark broadcasts it only if it is small
        pieces = spark.read.schema(pieces.schema).parquet(path)
    n_pieces = pieces.agg(F.count_distinct(S.PICKUP_DATE, "_pieza") + F.coalesce(F.sum(F.col("_partes") - 1), F.lit(0))).first()[0]
    if not n_pieces:
        return trips.hint("rebalance", S.PICKUP_DATE, S.DROPOFF_DATE)
    # Neighbouring pieces of a date go to one task, which writes their files one after the other: the number of tasks
    # follows the cores and the bytes of the load, not its number of files.
    group = max(1, min(n_pieces // (_TASKS_PER_CORE * session_cores(spark)), rows_per_piece(spark) // rows_per_file))
    part = F.pmod(F.xxhash64(S.MEDALLION, S.LICENSE, S.PICKUP_TIME, S.DROPOFF_TIME), F.ceil(F.col("_partes") / group).cast("int"))
    near = F.floor(F.col("_pieza") / group)
    cut = trips.withColumn("_slot", _slot()).join(pieces, [S.PICKUP_DATE, "_slot"], "left").withColumns({"_grupo": near, "_parte": part})
    # A number of partitions of its own, so that small pieces are not merged into files that span the day.
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * -(-n_pieces // group))
    return cut.repartition(width, S.PICKUP_DATE, S.DROPOFF_DATE, "_grupo", "_parte")


def layout_frame(
    df: DataFrame, layout: str = "flat", cluster: str = "counts", rows_per_file: int | None = None, scratch: list[str] | None = None
) -> DataFrame:
    """The frame :func:`write_trips` hands to the writer (see there for the options).

    ``scratch`` gets the folders that the frame reads from and its writer deletes.
    With ``counts`` a task may hold several pieces of a date: its writer needs the
    option ``maxRecordsPerFile``, the rows of a file.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, got {layout!r}")
    if cluster not in CLUSTERINGS:
        raise ValueError(f"cluster must be one of {CLUSTERINGS}, got {cluster!r}")
    if layout == "flat":
        return df
    out = with_layout_columns(df)
    columns = out.columns
    if cluster == "rebalance":
        out = out.hint("rebalance", S.PICKUP_DATE, S.DROPOFF_DATE)
    if cluster == "counts":
        out = _with_pieces(out, rows_per_file or rows_per_piece(df.sparkSession), [] if scratch is None else scratch).select(*columns)
    return out.sortWithinPartitions(S.PICKUP_DATE, S.DROPOFF_DATE, S.PICKUP_TIME)


def write_trips(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    layout: str = "flat",
    compression: str = "snappy",
    cluster: str = "counts",
    max_records_per_file: int | None = None,
    table: str | None = None,
    rows_per_file: int | None = None,
    index: bool | None = None,
) -> None:
    """Write processed trips as Parquet.

    ``flat``: the table as is (what the original wrote).

    ``by_date``: adds the layout columns and writes
    ``fecha_subida=.../fecha_bajada=...`` directories, each file sorted by
    pickup time (tight row-group statistics for time filters). Nearly every
    trip ends on its start date or the next, so a date has one or two
    drop-off sub-directories. ``index`` (on for this layout) adds the file
    index that :func:`open_trips` reads.

    ``cluster`` (``by_date`` only) chooses how rows reach the writers:

    * ``counts`` (default): the rows of every date and quarter hour are counted
      first; a date with more than ``rows_per_file`` rows is cut into pieces of
      the day, so each of its files covers a short time and a time-of-day band
      opens few; any other date stays whole, however many dates there are. One
      exchange by (dates, group of neighbouring pieces) moves the rows, of twice
      as many partitions as there are groups; a task cuts its rows, in time
      order, into files of ``rows_per_file``. A load without busy dates is
      rebalanced as below;
    * ``rebalance``: the same on the two dates alone, without counting; the
      files of a busy date each span the day;
    * ``local``: no exchange, each task sorts its own rows. For inputs that
      are already in time order (a time-sorted log), where each input split
      covers a short time span.

    ``rows_per_file`` follows ``spark.sql.adaptive.advisoryPartitionSizeInBytes``
    unless given (raise either to the target file size for large loads).

    ``table``: also register the output as a catalog table located at
    ``path`` (read it back with :func:`read_trips_table`).
    """
    if mode in ("error", "errorifexists") and _exists(df.sparkSession, path):
        # Before the counting, not after it.
        raise AnalysisException(f"[PATH_ALREADY_EXISTS] {path} exists already; choose another mode or path")
    scratch: list[str] = []
    writer_df = layout_frame(df, layout, cluster, rows_per_file, scratch)
    writer = writer_df.write.mode(mode).option("compression", compression)
    if layout == "by_date" and cluster == "counts":
        size = rows_per_file or rows_per_piece(df.sparkSession)
        max_records_per_file = min(size, max_records_per_file or size)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if layout == "by_date":
        writer = writer.partitionBy(S.PICKUP_DATE, S.DROPOFF_DATE)
    if table:
        writer.format("parquet").option("path", path).saveAsTable(table)
    else:
        writer.parquet(path)
    delete_paths(df.sparkSession, scratch)
    if layout == "by_date" if index is None else index:
        index_trips(df.sparkSession, path)


def _exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = file_system(spark, path)
    return fs.exists(hadoop_path(path))


def write_trips_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Processed rows as headerless CSV (same time format as the raw log).

    Columns are written in processed-table order, then any extra columns, so
    :func:`read_trips_csv` can read them back by position.
    """
    ordered = [*S.PROCESSED_COLUMNS, *[c for c in df.columns if c not in S.PROCESSED_COLUMNS]]
    (
        df.select(*ordered)
        .write.mode(mode)
        .option("header", "false")
        .option("timestampFormat", S.TIME_FORMAT)
        .option("timestampNTZFormat", S.TIME_FORMAT)
        .csv(path)
    )


def read_trips_csv(
    spark: SparkSession, path: str, extra: Sequence[tuple[str, str]] = ()
) -> DataFrame:
    """Read back :func:`write_trips_csv` output (processed schema + ``extra`` columns)."""
    schema = T.StructType(
        list(S.PROCESSED_SCHEMA.fields)
        + [T.StructField(name, T._parse_datatype_string(type_name), True) for name, type_name in extra]
    )
    return read_raw_trips(spark, path, schema=schema)


def write_result_line(lines: DataFrame, path: str, mode: str = "append") -> None:
    """Append result lines (column ``linea``) to a text sink."""
    lines.select("linea").coalesce(1).write.mode(mode).text(path)


TIMING_SCHEMA = T.StructType(
    [
        T.StructField("trabajo", T.StringType(), False),
        T.StructField("etiqueta", T.StringType(), True),
        T.StructField("segundos", T.DoubleType(), False),
        T.StructField("filas", T.LongType(), True),
        T.StructField("nucleos", T.IntegerType(), True),
        T.StructField("momento", T.TimestampNTZType(), False),
    ]
)


def session_cores(spark: SparkSession) -> int:
    """Cores that the session's tasks can use at once."""
    return spark.sparkContext.defaultParallelism


def timing_rows(
    spark: SparkSession,
    job: str,
    seconds: float,
    rows: int | None = None,
    cores: int | None = None,
    label: str | None = None,
) -> DataFrame:
    return spark.createDataFrame(
        [(job, label, float(seconds), rows, cores, _dt.datetime.now().replace(microsecond=0))],
        TIMING_SCHEMA,
    )


def append_timing(
    spark: SparkSession,
    path: str,
    job: str,
    seconds: float,
    rows: int | None = None,
    cores: int | None = None,
    label: str | None = None,
) -> None:
    """Append one timing row (job, label, seconds, rows, cores, time) as Parquet."""
    timing_rows(spark, job, seconds, rows, cores, label).coalesce(1).write.mode("append").parquet(path)


def read_timings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TIMING_SCHEMA).parquet(path)
