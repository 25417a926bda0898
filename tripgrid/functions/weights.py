"""Date-distance weights of the seasonal queries (Column -> Column).

Both weights compare the full timestamp with an interval around a reference
instant, so they are two literal comparisons per tier and stay in codegen.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .time import ts_sql

# Fixed values of the original seasonal queries.
# Seasonal routes: weight 2 within 30 days of the reference, else 1.
NEAR_DAYS = 30
NEAR_WEIGHT = 2
FAR_WEIGHT = 1
# Seasonal areas: influence 1.0 / 0.75 / 0.5 / 0.25 strictly within 7 / 14 / 21 / 28 days.
TIERS = ((7, 1.0), (14, 0.75), (21, 0.5), (28, 0.25))
# The original code's fourth tier could never match, so it only had three.
COMPAT_TIERS = ((7, 1.0), (14, 0.75), (21, 0.5))


def _strictly_within_sql(col: str, ref: _dt.datetime, days: float, data_type=None) -> str:
    delta = _dt.timedelta(days=days)
    return f"({col} > {ts_sql(ref - delta, data_type)} AND {col} < {ts_sql(ref + delta, data_type)})"


def near_weight(
    col: str,
    ref: _dt.datetime,
    days: float = NEAR_DAYS,
    near: int = NEAR_WEIGHT,
    far: int = FAR_WEIGHT,
    data_type=None,
) -> Column:
    """``near`` if ``|col - ref| < days`` (strict), else ``far`` (``col`` is a column name)."""
    return F.expr(f"CASE WHEN {_strictly_within_sql(col, ref, days, data_type)} THEN {int(near)} ELSE {int(far)} END")


def tier_weight_sql(
    col: str,
    ref: _dt.datetime,
    tiers: Sequence[tuple[float, float]] = TIERS,
    default: float | None = 0.0,
    data_type=None,
) -> str:
    """SQL text of :func:`tier_weight`."""
    whens = " ".join(
        f"WHEN {_strictly_within_sql(col, ref, days, data_type)} THEN CAST({float(weight)!r} AS DOUBLE)"
        for days, weight in sorted(tiers)
    )
    other = "CAST(NULL AS DOUBLE)" if default is None else f"CAST({float(default)!r} AS DOUBLE)"
    return f"CASE {whens} ELSE {other} END" if whens else other


def tier_weight(
    col: str,
    ref: _dt.datetime,
    tiers: Sequence[tuple[float, float]] = TIERS,
    default: float | None = 0.0,
    data_type=None,
) -> Column:
    """First tier whose window ``|col - ref| < days`` holds, else ``default`` (double).

    ``default=None`` gives NULL, which is what the original float UDF produced
    for rows outside every tier (they then drop out of means but not counts).
    """
    return F.expr(tier_weight_sql(col, ref, tiers, default, data_type))
