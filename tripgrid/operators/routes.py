"""Route aggregations: (pickup cell, drop-off cell) -> count or weighted count.

``groupBy`` plans as partial HashAggregate in the scan stage, one hash
exchange on the four cell keys, final HashAggregate. A hot route is combined
map-side, so key skew does not concentrate rows in one reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import ROUTE


def route_counts(trips: DataFrame, name: str = "viajes") -> DataFrame:
    """Trips per route."""
    return trips.groupBy(*ROUTE).agg(F.count(F.lit(1)).alias(name))


def weighted_route_counts(trips: DataFrame, weight: Column, name: str = "frecuencia") -> DataFrame:
    """Sum of a per-trip weight per route."""
    return trips.groupBy(*ROUTE).agg(F.sum(weight).alias(name))
