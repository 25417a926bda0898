"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tripgrid.session import ensure_checkpoint_dir, scratch_path

# A worker hands back an Arrow batch once its values reach this size.
BATCH_BYTES = 8 << 20
# Spark ends a batch that it sends to a worker at this size. Its own limits (10,000 rows, 64 MiB) make one batch of
# all texts of a task; executor and worker then hold each batch several times, outside the executor's heap.
SENT_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark (the folder may be in any store it reads)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it back.

    Used where a result is read more than once or a plan would grow in a
    loop. The copy survives the loss of any executor.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bound_sent_batches(spark: SparkSession) -> None:
    """From now on this session's workers get batches of about ``SENT_BYTES``."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(SENT_BYTES))


def parallelism(spark: SparkSession) -> int:
    """Number of shuffle partitions the session asks for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bounded_batches(rows: Iterable[tuple[int, tuple]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Arrow batches of about ``BATCH_BYTES`` from ``(size in bytes, values)`` pairs."""
    pending: list[tuple] = []
    size = 0
    for n_bytes, values in rows:
        pending.append(values)
        size += n_bytes + 32
        if size >= BATCH_BYTES or len(pending) >= 10_000:
            yield _batch(pending, schema)
            pending, size = [], 0
    if pending:
        yield _batch(pending, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(list(c), type=f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)
