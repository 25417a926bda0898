"""Money helpers.

Fares are ``decimal(10,2)``. Means are taken over integer cents
(``sum(cents) / count``, one IEEE division), which is exact up to the final
rounding and gives the same double in every engine, unlike a decimal mean whose
scale depends on the engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cents(col: Column | str) -> Column:
    """``decimal(10,2)`` amount -> ``bigint`` cents (exact)."""
    return (_col(col) * 100).cast("bigint")


def mean_cents(col: Column | str) -> Column:
    """Aggregate: mean of a cents column over its non-NULL values, as double.

    NULL when the group has no value.
    """
    c = _col(col)
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))


def mean_cents_sql(col: str) -> str:
    """SQL text of :func:`mean_cents` over a column name."""
    return f"try_divide(CAST(sum({col}) AS DOUBLE), CAST(count({col}) AS DOUBLE))"
