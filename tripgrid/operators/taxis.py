"""Taxi state: last drop-off, last pickup, free or occupied.

A taxi is free at the end of a window when it has a drop-off in the drop-off
window and no pickup strictly later than its last drop-off in the pickup
window. The original computed this with two global sorts, two
``dropDuplicates`` and a self join; ``areas.taxi_state`` is one aggregation
keyed by taxi. ``latest_per_key`` is the general form of "latest row per key":
``max(struct(time, tie-breaks..., payload...))``, deterministic and combined
map-side, so a taxi with a huge number of trips never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from .areas import taxi_state

__all__ = ["free_taxis", "latest_per_key", "taxi_state", "with_in_use_flag"]

_LAST = "_last"


def latest_per_key(
    df: DataFrame,
    key: Sequence[str],
    order: str,
    payload: Sequence[str] = (),
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """One row per ``key``: the row with the greatest ``order``.

    Ties on ``order`` go to the greatest ``tiebreak`` values, then the greatest
    payload, so the choice is the same on any partitioning.
    """
    fields = [order, *[c for c in tiebreak if c not in key], *[c for c in payload if c not in key]]
    last = F.max(F.struct(*[F.col(c) for c in fields])).alias(_LAST)
    return df.groupBy(*key).agg(last).select(*key, *[F.col(f"{_LAST}.{c}").alias(c) for c in fields])


def with_in_use_flag(state: DataFrame, at: Column) -> DataFrame:
    """Add ``taxi_en_uso``: 1 when the taxi's last pickup is strictly before ``at``.

    A trial flag of the original notebooks, kept next to ``taxi_ocupado``.
    """
    return state.withColumn(
        "taxi_en_uso", F.when(F.col(S.PICKUP_TIME) < at, 1).otherwise(0)
    )


def free_taxis(state: DataFrame) -> DataFrame:
    """Taxis (or taxi occurrences) that are not occupied."""
    return state.where(F.col("taxi_ocupado") == 0)
