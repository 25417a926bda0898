"""Exact selection of the first rows of an order, without ordering them all.

The rows that a prefix takes are found by counts. For each order column in turn
the rows still in question are counted in at most ``BUCKETS`` ranges of its
values; ranges before the one in which the prefix ends are taken whole, that
range is divided again, until it has at most ``BOUND`` rows or one value, and
then the next column decides. Only the last range is put in order. A count is
one aggregate with partial sums, so one second, or the rows without a time, may
hold any share of the table: no task orders more than ``BOUND`` rows, unless
more rows than that are equal in every order column that can be divided.

Whole numbers, decimals, times, dates, booleans and strings can be divided
(strings by the next character after those they share, so by their bytes'
order). Floating-point columns cannot; they end the division.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 1000
BOUND = 100_000


@dataclass
class Selection:
    """The first ``n`` rows of an order: all that ``whole`` tells, and the first ``rest`` of ``last``."""

    whole: list[Column] = field(default_factory=list)
    last: Column | None = None
    rest: int = 0
    n_last: int = 0  # rows of which the rest is taken

    def rows(self, df: DataFrame, order: Sequence[str]) -> DataFrame:
        taken = F.lit(False)
        for condition in self.whole:
            taken = taken | F.coalesce(condition, F.lit(False))
        out = df.where(taken)
        if self.last is None or not self.rest:
            return out
        keys = [F.col(c).asc_nulls_last() for c in order]
        return out.unionByName(df.where(self.last).orderBy(*keys).limit(self.rest))


def _as_number(column: str, data_type: T.DataType) -> Column | None:
    """Whole numbers in the column's order; None where it has none that are exact."""
    c = F.col(column)
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("decimal(20,0)")
    if isinstance(data_type, T.DecimalType) and data_type.precision <= 28:
        return (c * F.lit(10**data_type.scale)).cast("decimal(38,0)")
    if isinstance(data_type, T.BooleanType):
        return c.cast("int").cast("decimal(20,0)")
    if isinstance(data_type, T.DateType):
        return F.unix_date(c).cast("decimal(20,0)")
    if isinstance(data_type, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01', {column})").cast("decimal(20,0)")
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(c).cast("decimal(20,0)")
    return None


def _ending(counts: list[tuple[object, int]], n: int) -> tuple[object, int, int]:
    """Key in which the first ``n`` rows end (nulls last), rows before it, and its own rows."""
    before = 0
    for key, rows in sorted(counts, key=lambda x: (x[0] is None, x[0] if x[0] is not None else 0)):
        if n <= before + rows:
            return key, before, rows
        before += rows
    raise ValueError("fewer rows than asked for")


def select_first(
    df: DataFrame, n: int, order: Sequence[str], within: Column, bound: int | None = None, rows: int | None = None
) -> Selection:
    """The first ``n`` of the rows of ``df`` that ``within`` tells, by ``order`` ascending, nulls last.

    ``rows`` is how many those are, if the caller has counted them.
    """
    bound = BOUND if bound is None else bound
    found = Selection()
    here, rows = within, df.where(within).count() if rows is None else rows
    if n >= rows:
        return Selection(whole=[within] if n > 0 else [])
    if n <= 0:
        return found
    types = {f.name: f.dataType for f in df.schema.fields}
    for column in order:
        text = isinstance(types[column], T.StringType)
        if rows <= bound or not (text or _as_number(column, types[column]) is not None):
            break
        divided = _divide_text if text else _divide_number
        here, n, rows = divided(df, column, types[column], here, n, rows, found, bound)
        if n == rows:  # the prefix ends with a range
            found.whole.append(here)
            return found
    found.last, found.rest, found.n_last = here, n, rows
    return found


def _divide_number(df, column, data_type, here, n, rows, found: Selection, bound: int):
    number = _as_number(column, data_type)
    c = F.col(column)
    nulls, least, most = df.where(here).agg(F.count_if(c.isNull()), F.min(number), F.max(number)).first()
    if n > rows - nulls:
        found.whole.append(here & c.isNotNull())
        return here & c.isNull(), n - (rows - nulls), nulls
    here, rows = here & c.isNotNull(), rows - nulls
    while rows > bound and least < most and n < rows:
        width = int(most - least) // BUCKETS + 1
        start = F.lit(least).cast("decimal(38,0)")
        bucket = F.floor((number - start) / F.lit(width).cast("decimal(20,0)")).cast("int") if width > 1 else (number - start).cast("int")
        # A range's own least and greatest values bound the next division.
        counted = df.where(here).groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min(number).alias("least"), F.max(number).alias("most")).collect()
        at, before, rows = _ending([(r.b, r.n) for r in counted], n)
        least, most = next((r.least, r.most) for r in counted if r.b == at)
        lower, upper = F.lit(least).cast("decimal(38,0)"), F.lit(most).cast("decimal(38,0)")
        if before:
            found.whole.append(here & (number < lower))
        here, n = here & (number >= lower) & (number <= upper), n - before
    return here, n, rows


def _divide_text(df, column, data_type, here, n, rows, found: Selection, bound: int):
    c = F.col(column)
    nulls = df.where(here & c.isNull()).count()
    if n > rows - nulls:
        found.whole.append(here & c.isNotNull())
        return here & c.isNull(), n - (rows - nulls), nulls
    here, rows = here & c.isNotNull(), rows - nulls
    while rows > bound and n < rows:
        least, most = df.where(here).agg(F.min(c), F.max(c)).first()
        if least == most:
            break
        shared = 0
        while shared < min(len(least), len(most)) and least[shared] == most[shared]:
            shared += 1
        prefix = F.substring(c, 1, shared + 1)  # one row for each next character
        counted = [(r.p, r.n) for r in df.where(here).groupBy(prefix.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
        counted = [(p.encode(), k) for p, k in counted]  # Spark orders strings by their bytes
        at, before, rows = _ending(counted, n)
        here, n, earlier = here & (prefix == at.decode()), n - before, here & (prefix < at.decode())
        if before:
            found.whole.append(earlier)
    return here, n, rows
