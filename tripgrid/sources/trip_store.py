"""A stored trip table with a file index (zone map), and its compaction.

The index is a small Parquet table beside the data, in the hidden folder
``_archivos``: a row per file with its rows, bytes and the least and greatest
pickup and drop-off time. A query asks the index which files can hold rows of
its window and opens these alone, with the declared schema: no directory is
listed, no footer read for a schema, and the cost does not grow with the number
of dates.

Every change writes a whole new generation of the index, ``v=1``, ``v=2`` ...;
readers take the last one whose ``_SUCCESS`` marker exists. The marker is made
last, in one step, on any file system, so a reader sees the files of one
generation or of the next, never a mixture. Files that a generation does not
name (of a failed load or compaction, or replaced by one) are not read;
``vacuum`` deletes the replaced ones. One job at a time changes a table.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.time import parse_time, ts_sql
from ..session import delete_paths, file_system

INDEX_FOLDER = "_archivos"
_MARKER = "_SUCCESS"
# Files of a compaction enter the index by its own generation alone, never by a listing.
_COMPACTED = "compacto-"
# Up to so many files are looked up by the driver itself, more by a Spark job.
_LISTED_BY_DRIVER = 512
_LISTING_CONF = "spark.sql.sources.parallelPartitionDiscovery.threshold"
# Tasks of that job for each core; Spark's own number is one for each file, up to 10,000.
_LISTING_TASKS_PER_CORE = 4
_LISTING_TASKS_CONF = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

INDEX_SCHEMA = T.StructType(
    [
        T.StructField("archivo", T.StringType(), False),  # path below the table's folder
        T.StructField("filas", T.LongType(), False),
        T.StructField("bytes", T.LongType(), False),
        T.StructField("min_hora_subida", T.TimestampNTZType(), True),
        T.StructField("max_hora_subida", T.TimestampNTZType(), True),
        T.StructField("min_hora_bajada", T.TimestampNTZType(), True),
        T.StructField("max_hora_bajada", T.TimestampNTZType(), True),
        T.StructField("vigente", T.BooleanType(), False),  # false: replaced by a compaction
        T.StructField("esquema", T.StringType(), False),  # the table's schema as JSON
    ]
)

# ---------------------------------------------------------------------------
# Which files can hold a row: SQL over the index. A file without a time of a
# kind has NULL bounds, and no row of it satisfies a condition on that time.
# ---------------------------------------------------------------------------


def in_window_sql(column: str, lo: _dt.datetime, hi: _dt.datetime) -> str:
    """Files that may hold times of ``column`` between two instants."""
    return f"(max_{column} >= {ts_sql(lo)} AND min_{column} <= {ts_sql(hi)})"


def _second_sql(column: str) -> str:
    return f"(hour({column}) * 3600 + minute({column}) * 60 + second({column}))"


def _one_date_sql(column: str) -> str:
    return f"to_date(min_{column}) = to_date(max_{column})"


def in_band_sql(column: str, lo: str | _dt.time, hi: str | _dt.time, wrap: bool = True) -> str:
    """Files that may hold times of ``column`` in a band of the day; files of several dates may."""
    lo_t, hi_t = parse_time(lo), parse_time(hi)
    first, last = (t.hour * 3600 + t.minute * 60 + t.second for t in (lo_t, hi_t))
    least, most = _second_sql(f"min_{column}"), _second_sql(f"max_{column}")
    if lo_t <= hi_t:
        inside = f"({most} >= {first} AND {least} <= {last})"
    else:
        inside = f"({most} >= {first} OR {least} <= {last})" if wrap else "false"
    return f"(NOT ({_one_date_sql(column)}) OR {inside})"


def on_weekday_sql(column: str, weekday: int, or_day_before: bool = False) -> str:
    """Files that may hold times of ``column`` on a weekday (Monday = 0); files of several dates may."""
    days = f"{int(weekday)}, {(int(weekday) - 1) % 7}" if or_day_before else f"{int(weekday)}"
    return f"(NOT ({_one_date_sql(column)}) OR weekday(min_{column}) IN ({days}))"


def _generations(spark: SparkSession, path: str) -> list[tuple[int, bool]]:
    """Numbers of the index's generations, and whether each is complete."""
    fs, hadoop_path = file_system(spark, path)
    folder = hadoop_path(f"{path}/{INDEX_FOLDER}")
    if not fs.exists(folder):
        return []
    found = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("v=") and name[2:].isdigit():
            found.append((int(name[2:]), fs.exists(hadoop_path(status.getPath(), _MARKER))))
    return sorted(found)


# Indexes kept in the driver, by application, table and generation: of at most so many files and tables.
_KEPT: dict[tuple[str, str, int], DataFrame | None] = {}
_KEPT_FILES, _KEPT_TABLES = 20_000, 8


class TripStore:
    """One generation of a stored, indexed trip table; queries take it in place of a frame."""

    def __init__(self, spark: SparkSession, path: str, generation: int | None = None) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        if generation is None:
            complete = [n for n, done in _generations(spark, self.path) if done]
            if not complete:
                raise FileNotFoundError(f"no file index below {path}: write the table with write_trips, or call index_trips")
            generation = complete[-1]
        self.generation = generation

    def index(self) -> DataFrame:
        """All rows of this generation's index, replaced files too."""
        return self.spark.read.schema(INDEX_SCHEMA).parquet(f"{self.path}/{INDEX_FOLDER}/v={self.generation}")

    def _kept(self) -> DataFrame:
        """The index for lookups: a small one stays in the driver, so that a lookup needs no job.

        A generation never changes, so what is kept cannot get old.
        """
        key = (self.spark.sparkContext.applicationId, self.path, self.generation)
        if key not in _KEPT:
            some = self.index()._jdf.limit(_KEPT_FILES + 1).collectAsList()
            local = None
            if some.size() <= _KEPT_FILES:
                session = self.spark._jsparkSession
                local = DataFrame(session.createDataFrame(some, self.index()._jdf.schema()), self.spark)
            while len(_KEPT) >= _KEPT_TABLES:
                _KEPT.pop(next(iter(_KEPT)))
            _KEPT[key] = local
        found = _KEPT[key]
        return self.index() if found is None else found

    def files(self, where: str = "true") -> DataFrame:
        """Files of the table that can hold rows of ``where``, SQL over the index."""
        return self._kept().where(f"vigente AND ({where})")

    def frame(self, where: str = "true") -> DataFrame:
        """The trips of those files; a query still applies its own conditions to the rows."""
        found = self.files(where).select("archivo", "esquema").collect()
        if found:
            return read_files(self.spark, self.path, [r.archivo for r in found], _schema(found[0].esquema))
        any_row = self._kept().select("esquema").first()
        return self.spark.createDataFrame([], _schema(any_row.esquema) if any_row else S.PROCESSED_SCHEMA)


Trips = DataFrame | TripStore


def stored(trips: Trips, where: str) -> DataFrame:
    """The frame itself, or of a store the files that can hold rows of ``where``."""
    return trips.frame(where) if isinstance(trips, TripStore) else trips


def _schema(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


def read_files(spark: SparkSession, path: str, files: Sequence[str], schema: T.StructType) -> DataFrame:
    """Some files of a table with a declared schema; their folders give the partition columns."""
    paths = [f"{path}/{f}" for f in files]
    before = {c: spark.conf.get(c) for c in (_LISTING_CONF, _LISTING_TASKS_CONF)}
    if int(before[_LISTING_CONF]) < len(paths) <= _LISTED_BY_DRIVER:
        spark.conf.set(_LISTING_CONF, str(_LISTED_BY_DRIVER))
    tasks = min(int(before[_LISTING_TASKS_CONF]), _LISTING_TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    spark.conf.set(_LISTING_TASKS_CONF, str(tasks))
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(*paths)
    finally:
        for c, value in before.items():
            spark.conf.set(c, value)


# ---------------------------------------------------------------------------
# Building
# ---------------------------------------------------------------------------


def _relative(file_path: Column, depth: int) -> Column:
    return F.substring_index(file_path, "/", -(1 + depth))


def _measured(trips: DataFrame, partitioned: bool) -> DataFrame:
    """Index rows of the files that ``trips`` reads: one pass over two columns."""
    depth = 2 if partitioned else 0
    bounds = [f(F.col(c).cast("timestamp_ntz")).alias(f"{n}_{c}") for c in (S.PICKUP_TIME, S.DROPOFF_TIME) for n, f in (("min", F.min), ("max", F.max))]
    rows = trips.select(S.PICKUP_TIME, S.DROPOFF_TIME, F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_size").alias("_size"))
    by_file = rows.groupBy(_relative(F.col("_path"), depth).alias("archivo")).agg(F.count(F.lit(1)).alias("filas"), F.max("_size").alias("bytes"), *bounds)
    return by_file.withColumns({"vigente": F.lit(True), "esquema": F.lit(trips.schema.json())}).select(*INDEX_SCHEMA.names)


def _write_generation(rows: DataFrame, spark: SparkSession, path: str, after: int) -> TripStore:
    """Write the next generation; an unfinished one of the same number is stepped over."""
    number = max([after, *(n for n, _ in _generations(spark, path))]) + 1
    rows.coalesce(1).write.parquet(f"{path}/{INDEX_FOLDER}/v={number}")
    return TripStore(spark, path, number)


def index_trips(spark: SparkSession, path: str) -> TripStore:
    """Index the table at ``path``: all its files, or those that the last generation does not know.

    Files count if Spark's own reader of the folder sees them, so those of an
    uncommitted streaming batch do not. Known files keep their rows.
    """
    path = path.rstrip("/")
    complete = [n for n, done in _generations(spark, path) if done]
    known = TripStore(spark, path, complete[-1]) if complete else None
    a_row = known.index().select("esquema").first() if known else None
    try:
        # With a known schema the folder is only listed.
        trips = (spark.read.schema(_schema(a_row.esquema)) if a_row else spark.read).parquet(path)
    except AnalysisException as error:
        # A load without rows leaves no file to take a schema from.
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return known or _write_generation(spark.createDataFrame([], INDEX_SCHEMA), spark, path, 0)
    partitioned = S.PICKUP_DATE in trips.columns and S.DROPOFF_DATE in trips.columns
    if not a_row:
        return _write_generation(_measured(trips, partitioned), spark, path, known.generation if known else 0)
    names = {r.archivo for r in known.index().select("archivo").toLocalIterator()}  # a row per file, as in the listing
    depth = 2 if partitioned else 0
    new = [f for f in ("/".join(p.split("/")[-1 - depth :]) for p in trips.inputFiles()) if f not in names]
    new = [f for f in new if not f.split("/")[-1].startswith(_COMPACTED)]
    if not new:
        return known
    schema = spark.read.option("basePath", path).parquet(f"{path}/{new[0]}").schema
    measured = _measured(read_files(spark, path, new, schema), partitioned)
    return _write_generation(known.index().unionByName(measured), spark, path, known.generation)


# ---------------------------------------------------------------------------
# Compaction
# ---------------------------------------------------------------------------


def compact_trips(spark: SparkSession, path: str, rows_per_file: int | None = None) -> TripStore:
    """Merge the small files of every date into files as the batch load writes them.

    A date is rewritten if it has at least twice the files it needs. The new
    files are written beside the old ones and named by the next generation in
    their place: a reader by the index sees every row once before, during and
    after. Readers that list the folder themselves see the rewritten rows twice
    until ``vacuum``.
    """
    from .trips_io import layout_frame, rows_per_piece

    store = index_trips(spark, path)
    size = rows_per_file or rows_per_piece(spark)
    folder = F.substring_index("archivo", "/", 1)
    files = store.files().withColumn("carpeta", folder)
    crowded = files.groupBy("carpeta").agg(F.count(F.lit(1)).alias("n"), F.ceil(F.sum("filas") / size).alias("needed")).where("n >= 2 * greatest(needed, 1)")
    chosen = files.join(crowded, "carpeta", "left_semi").select("archivo", "esquema").collect()  # file names, as in a listing
    if not chosen:
        return store
    old = [r.archivo for r in chosen]
    trips = read_files(spark, store.path, old, _schema(chosen[0].esquema))
    name, scratch = f"{_COMPACTED}{uuid.uuid4().hex}", []
    writer = layout_frame(trips.drop(*S.LAYOUT_COLUMNS), "by_date", rows_per_file=size, scratch=scratch).write.mode("append")
    writer.option("mapreduce.output.basename", name).option("maxRecordsPerFile", size).partitionBy(S.PICKUP_DATE, S.DROPOFF_DATE).parquet(store.path)
    delete_paths(spark, scratch)
    new = [f for f in _data_files(spark, store.path) if f.split("/")[-1].startswith(name)]
    replaced = spark.createDataFrame([(f,) for f in old], "archivo string")
    kept = store.index().join(replaced.withColumn("alt", F.lit(True)), "archivo", "left")
    kept = kept.withColumn("vigente", F.col("vigente") & F.col("alt").isNull()).select(*INDEX_SCHEMA.names)
    measured = _measured(read_files(spark, store.path, new, trips.schema), True)
    return _write_generation(kept.unionByName(measured), spark, store.path, store.generation)


def _data_files(spark: SparkSession, path: str) -> list[str]:
    """Data files below a table's folder, hidden ones left out."""
    fs, hadoop_path = file_system(spark, path)
    found, listing = [], fs.listFiles(hadoop_path(path), True)
    root = fs.makeQualified(hadoop_path(path)).toUri().getPath().rstrip("/") + "/"
    while listing.hasNext():
        name = listing.next().getPath().toUri().getPath()[len(root) :]
        if not any(part.startswith(("_", ".")) for part in name.split("/")):
            found.append(name)
    return found


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete the files that a compaction replaced; returns how many. Readers of older generations must be done."""
    store = TripStore(spark, path)
    fs, hadoop_path = file_system(spark, store.path)
    n = 0
    for r in store.index().where("NOT vigente").select("archivo").toLocalIterator():
        n += bool(fs.delete(hadoop_path(f"{store.path}/{r.archivo}"), False))
    return n
