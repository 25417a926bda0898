"""The grid dimension: one row per cell with its north-west corner."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.grid import GRID_SIZE, cell_corner_lat, cell_corner_lon


def grid_cells(spark: SparkSession, size: int = GRID_SIZE, num_partitions: int | None = None) -> DataFrame:
    """``X``, ``Y`` (1..size) and ``LATITUD``, ``LONGITUD`` of the NW corner.

    Generated from ``spark.range(size * size)`` with arithmetic on the id, so
    there is no cross join and every task builds its own slice of the grid.
    """
    ids = spark.range(0, size * size, 1, num_partitions) if num_partitions else spark.range(size * size)
    return ids.select(
        (F.col("id") % size + 1).alias("X"),
        (F.floor(F.col("id") / size) + 1).alias("Y"),
    ).select("X", "Y", cell_corner_lat("Y").alias("LATITUD"), cell_corner_lon("X").alias("LONGITUD"))
