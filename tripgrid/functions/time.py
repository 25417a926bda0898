"""Time literals, windows and time-of-day bands (Column -> Column).

Every predicate here is a native Catalyst expression. Absolute windows compare
the raw column with typed literals, so Parquet receives them as pushed filters.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_US_PER_SECOND = 1_000_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------
# Driver-side parameters (the query arguments of the original command lines)
# ---------------------------------------------------------------------------


def instant(date: str | _dt.date, hhmm: str | _dt.time = "00:00") -> _dt.datetime:
    """Instant from ``YYYY-MM-DD`` and ``HH:MM`` (seconds optional)."""
    if isinstance(date, str):
        date = _dt.date.fromisoformat(date)
    return _dt.datetime.combine(date, parse_time(hhmm))


def parse_time(hhmm: str | _dt.time) -> _dt.time:
    """``HH:MM`` or ``HH:MM:SS`` -> ``datetime.time``."""
    if isinstance(hhmm, _dt.time):
        return hhmm
    parts = [int(p) for p in hhmm.split(":")]
    if len(parts) == 2:
        parts.append(0)
    if len(parts) != 3:
        raise ValueError(f"expected HH:MM or HH:MM:SS, got {hhmm!r}")
    return _dt.time(*parts)


def to_instant(value: str | _dt.datetime) -> _dt.datetime:
    """Accept a ``datetime`` or ``'YYYY-MM-DD HH:MM[:SS]'``."""
    if isinstance(value, _dt.datetime):
        return value
    return _dt.datetime.fromisoformat(value)


def minus_minutes(value: _dt.datetime, minutes: float) -> _dt.datetime:
    return value - _dt.timedelta(minutes=minutes)


def time_to_micros(t: _dt.time) -> int:
    return ((t.hour * 60 + t.minute) * 60 + t.second) * _US_PER_SECOND + t.microsecond


# ---------------------------------------------------------------------------
# Literals typed like the column they are compared with
# ---------------------------------------------------------------------------
#
# The predicates below are written as SQL text and parsed once by ``F.expr``:
# the same Catalyst expressions as the Column API builds, at a fraction of the
# driver round trips (a composite predicate costs one call instead of dozens).
# Their column arguments are column names (or SQL expressions) for that reason.


def ts_sql(value: str | _dt.datetime, data_type: T.DataType | None = None) -> str:
    """SQL text of a timestamp literal; ``TIMESTAMP_NTZ`` unless ``data_type`` is TIMESTAMP."""
    text = to_instant(value).isoformat(sep=" ")
    keyword = "TIMESTAMP" if isinstance(data_type, T.TimestampType) else "TIMESTAMP_NTZ"
    return f"{keyword} '{text}'"


def ts_literal(value: str | _dt.datetime, data_type: T.DataType | None = None) -> Column:
    """Timestamp literal column (folded by the optimizer, so comparisons push down)."""
    return F.expr(ts_sql(value, data_type))


def ts_literal_for(df: DataFrame, column: str, value: str | _dt.datetime) -> Column:
    """Literal with the same timestamp type as ``df[column]``."""
    return ts_literal(value, df.schema[column].dataType)


# ---------------------------------------------------------------------------
# Windows and bands
# ---------------------------------------------------------------------------

_CLOSED = {"both": (">=", "<="), "right": (">", "<="), "left": (">=", "<"), "neither": (">", "<")}


def _bounds(closed: str) -> tuple[str, str]:
    if closed not in _CLOSED:
        raise ValueError(f"closed must be both/right/left/neither, got {closed!r}")
    return _CLOSED[closed]


def in_window(col: Column | str, lo: Column, hi: Column, closed: str = "both") -> Column:
    """``lo (<|<=) col (<|<=) hi`` for arbitrary bound columns; ``closed`` is both, right, left or neither."""
    c = _col(col)
    lower_op, upper_op = _bounds(closed)
    lower = c >= lo if lower_op == ">=" else c > lo
    upper = c <= hi if upper_op == "<=" else c < hi
    return lower & upper


def window_sql(
    col: str, lo: _dt.datetime, hi: _dt.datetime, closed: str = "both", data_type: T.DataType | None = None
) -> str:
    lower_op, upper_op = _bounds(closed)
    return f"({col} {lower_op} {ts_sql(lo, data_type)} AND {col} {upper_op} {ts_sql(hi, data_type)})"


def in_window_at(
    col: str, lo: _dt.datetime, hi: _dt.datetime, closed: str = "both", data_type: T.DataType | None = None
) -> Column:
    """``col`` within the absolute window ``lo .. hi`` (timestamp literals typed like the column)."""
    return F.expr(window_sql(col, lo, hi, closed, data_type))


def weekday0(col: Column | str) -> Column:
    """Day of week with Monday = 0 ... Sunday = 6."""
    return F.weekday(_col(col))


def time_of_day_sql(col: str) -> str:
    """SQL text: microseconds since the row's own midnight (exact, fractional seconds kept)."""
    # extract(SECOND ...) is decimal(8,6): seconds with the microsecond fraction.
    return (
        f"(CAST(hour({col}) * 3600 + minute({col}) * 60 AS BIGINT) * {_US_PER_SECOND}"
        f" + CAST(extract(SECOND FROM {col}) * {_US_PER_SECOND} AS BIGINT))"
    )


def time_of_day_micros(col: str) -> Column:
    """Microseconds since the row's own midnight."""
    return F.expr(time_of_day_sql(col))


def time_of_day_band_sql(col: str, lo: str | _dt.time, hi: str | _dt.time, wrap: bool = True) -> str:
    lo_us = time_to_micros(parse_time(lo))
    hi_us = time_to_micros(parse_time(hi))
    tod = time_of_day_sql(col)
    if lo_us <= hi_us:
        return f"({tod} BETWEEN {lo_us}L AND {hi_us}L)"
    if not wrap:
        return "false"
    return f"({tod} >= {lo_us}L OR {tod} <= {hi_us}L)"


def in_time_of_day(
    col: str,
    lo: str | _dt.time,
    hi: str | _dt.time,
    wrap: bool = True,
) -> Column:
    """Time of day of ``col`` within the closed band ``[lo, hi]`` on any date.

    A band with ``lo > hi`` crosses midnight. With ``wrap`` it means
    ``tod >= lo OR tod <= hi``; without it the band is empty, which is what the
    original code did.
    """
    return F.expr(time_of_day_band_sql(col, lo, hi, wrap))


def band_before(end: str | _dt.time, minutes: float) -> tuple[_dt.time, _dt.time]:
    """The band ``[end - minutes, end]`` as two times of day (may cross midnight)."""
    end_t = parse_time(end)
    start = (_dt.datetime.combine(_dt.date(2000, 1, 2), end_t) - _dt.timedelta(minutes=minutes)).time()
    return start, end_t


def crosses_midnight(lo: str | _dt.time, hi: str | _dt.time) -> bool:
    return time_to_micros(parse_time(lo)) > time_to_micros(parse_time(hi))


def band_occurrence_date(col: str, end: str | _dt.time) -> Column:
    """Date on which the band occurrence that contains ``col`` ends.

    For a band that does not cross midnight this is the row's own date. For one
    that does (say 23:45-00:15), a row at 23:50 belongs to the next day's band.
    """
    end_us = time_to_micros(parse_time(end))
    return F.expr(
        f"CASE WHEN {time_of_day_sql(col)} <= {end_us}L THEN to_date({col}) ELSE date_add(to_date({col}), 1) END"
    )
