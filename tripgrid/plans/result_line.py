"""Result lines: a ranked top-k result formatted as one text line.

Route line: ``start, end, 0: (a, b) (c, d), 1: ..., elapsed``
Area line:  ``start, end, 0: (a, b) 1: (a, b) ..., elapsed``

The line is built on the executors from the k ranked rows (collect_list over
at most k rows, sorted by rank), not on the driver.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S


def _line(ranked: DataFrame, item: Column, name: str, start, end, elapsed: float | None) -> DataFrame:
    items = F.sort_array(F.collect_list(F.struct(F.col("rank"), item.alias("s"))))
    body = F.array_join(F.transform(items, lambda x: x["s"]), "")
    prefix = f"{start}, {end}, "
    suffix = "" if elapsed is None else str(elapsed)
    return ranked.agg(body.alias("items")).select(
        F.lit(name).alias("consulta"),
        F.concat(F.lit(prefix), F.col("items"), F.lit(suffix)).alias("linea"),
    )


def route_line(
    ranked: DataFrame,
    name: str,
    start: _dt.datetime | _dt.time,
    end: _dt.datetime | _dt.time,
    elapsed: float | None = None,
) -> DataFrame:
    """One-row frame (consulta, linea) for a ranked route result."""
    a, b, c, d = (F.col(x) for x in S.ROUTE)
    item = F.format_string("%d: (%d, %d) (%d, %d), ", F.col("rank"), a, b, c, d)
    return _line(ranked, item, name, start, end, elapsed)


def area_line(
    ranked: DataFrame,
    name: str,
    start: _dt.datetime | _dt.time,
    end: _dt.datetime | _dt.time,
    elapsed: float | None = None,
) -> DataFrame:
    """One-row frame (consulta, linea) for a ranked area result."""
    lat, lon = (F.col(x) for x in S.AREA)
    item = F.format_string("%d: (%d, %d) ", F.col("rank"), lat, lon)
    return _line(ranked, item, name, start, end, elapsed)
