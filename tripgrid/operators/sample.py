"""First ``n`` rows of a time-ordered table, and the size ladder of the benchmarks.

One plan for every ``n``, without sorting the table: rows are counted per day
of the first order column (a row per day), then per second of the days in which
a prefix ends (at most 86,400 rows each). All rows before a prefix's last
second belong to it; the rows of that one second, or those without a time, are
divided further by counts over the order columns (``select``), so a busy second
or a long tail of missing times is never put in order whole. Any number of
prefixes share the counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import TIME_FORMAT
from .select import Selection, select_first

# The prefix sizes of the original size ladder, as fractions of
# the whole log (1/1000, 1/500, 1/50, 1/10 ... 9/10, all).
LADDER_FRACTIONS = (
    (1, 1000),
    (1, 500),
    (1, 50),
    (1, 10),
    (2, 10),
    (3, 10),
    (4, 10),
    (5, 10),
    (6, 10),
    (7, 10),
    (8, 10),
    (9, 10),
    (1, 1),
)


@dataclass(frozen=True)
class Cutoff:
    """A prefix: all rows before ``second``, and the first ``ties`` of its ``rows`` rows.

    ``second`` is None where the prefix ends among the rows without a time,
    which come last; ``everything`` tells that it holds the whole table.
    """

    size: int
    second: object
    ties: int
    everything: bool = False
    rows: int = 0


def _second(order: Sequence[str]) -> Column:
    return F.date_trunc("second", F.col(order[0]).cast("timestamp_ntz")).cast("timestamp_ntz")


def _ends(counts: list[tuple[object, int]], sizes: Sequence[int]) -> dict[int, tuple[object, int, int]]:
    """For each size the key in which the prefix ends, the rows it takes of it, and the key's rows."""
    out, before = {}, 0
    for key, n in sorted(counts, key=lambda x: (x[0] is None, x[0])):
        for size in sizes:
            if before < size <= before + n:
                out[size] = (key, size - before, n)
        before += n
    return out


def prefix_cutoffs(df: DataFrame, sizes: Sequence[int] | None, order: Sequence[str], fractions=()) -> list[Cutoff]:
    """Where the prefixes of the given sizes (or fractions of the rows) end."""
    day = F.to_date(F.col(order[0]))
    days = [tuple(r) for r in df.groupBy(day.alias("day")).agg(F.count(F.lit(1))).collect()]  # a row per day
    total = sum(n for _, n in days)
    sizes = list(sizes) if sizes is not None else ladder_sizes(total, fractions)
    in_days = _ends(days, sizes)
    ending = sorted({d for d, _, _ in in_days.values() if d is not None})
    seconds: dict[object, list[tuple[object, int]]] = {}
    if ending:
        counted = df.where(day.isin(ending)).groupBy(day.alias("day"), _second(order).alias("second")).agg(F.count(F.lit(1)).alias("n"))
        for r in counted.toLocalIterator():  # at most 86,400 rows for each prefix
            seconds.setdefault(r.day, []).append((r.second, r.n))
    out = []
    for size in sizes:
        if size >= total or size <= 0:
            out.append(Cutoff(size, None, 0, everything=size > 0))
            continue
        last_day, of_day, n_day = in_days[size]
        second, ties, rows = (None, of_day, n_day) if last_day is None else _ends(seconds[last_day], [of_day])[of_day]
        out.append(Cutoff(size, second, ties, rows=rows))
    return out


def _parts(cutoff: Cutoff, second: Column) -> tuple[Column, Column]:
    """The rows before a prefix's last second, and the rows of that second (or without a time)."""
    if cutoff.second is None:
        return second.isNotNull(), second.isNull()
    end = F.lit(cutoff.second).cast("timestamp_ntz")
    return second < end, second == end


def _selection(df: DataFrame, cutoff: Cutoff, order: Sequence[str], bound: int | None = None) -> Selection:
    """What a prefix takes of the table."""
    if cutoff.everything:
        return Selection(whole=[F.lit(True)])
    if cutoff.size <= 0:
        return Selection()
    before, last = _parts(cutoff, _second(order))
    found = select_first(df, cutoff.ties, order, last, bound, cutoff.rows)
    return Selection([before, *found.whole], found.last, found.rest, found.n_last)


def _prefix(df: DataFrame, cutoff: Cutoff, order: Sequence[str], bound: int | None = None) -> DataFrame:
    return _selection(df, cutoff, order, bound).rows(df, order)


def prefix_sample(df: DataFrame, n: int, order: Sequence[str], bound: int | None = None) -> DataFrame:
    """The first ``n`` rows of ``df`` ordered by ``order`` (ascending, nulls last).

    ``order`` begins with a timestamp; include enough tie columns to make it
    total, or the choice among equal rows is arbitrary. At most ``bound`` rows
    (``select.BOUND``) are put in order, see ``select``.
    """
    return _prefix(df, prefix_cutoffs(df, [n], order)[0], order, bound)


def ladder_sizes(total: int, fractions: Sequence[tuple[int, int]] = LADDER_FRACTIONS) -> list[int]:
    """Prefix sizes ``total * num // den`` (integer arithmetic)."""
    return [total * num // den for num, den in fractions]


def size_ladder(
    df: DataFrame,
    order: Sequence[str],
    fractions: Sequence[tuple[int, int]] = LADDER_FRACTIONS,
    sizes: Sequence[int] | None = None,
) -> list[tuple[int, DataFrame]]:
    """``[(size, prefix)]`` for every ladder fraction, or for the given ``sizes``."""
    return [(c.size, _prefix(df, c, order)) for c in prefix_cutoffs(df, sizes, order, fractions)]


def write_size_ladder(
    df: DataFrame,
    out_dir: str,
    order: Sequence[str],
    fractions: Sequence[tuple[int, int]] = LADDER_FRACTIONS,
    fmt: str = "csv",
    mode: str = "errorifexists",
    sizes: Sequence[int] | None = None,
) -> list[tuple[int, str]]:
    """Write every prefix to ``{out_dir}/{size}`` (CSV by default, as the original logs)."""
    written = []
    for n, prefix in size_ladder(df, order, fractions, sizes):
        path = f"{out_dir.rstrip('/')}/{n}"
        writer = prefix.write.mode(mode).format(fmt)
        if fmt == "csv":
            # Same headerless layout and time format as the raw log, so the
            # prefixes read back with the raw-log reader.
            writer = writer.option("header", "false").option("timestampFormat", TIME_FORMAT).option(
                "timestampNTZFormat", TIME_FORMAT
            )
        writer.save(path)
        written.append((n, path))
    return written


def ladder_summary(
    df: DataFrame,
    order: Sequence[str],
    fractions: Sequence[tuple[int, int]] = LADDER_FRACTIONS,
    sizes: Sequence[int] | None = None,
) -> DataFrame:
    """One row per ladder size: (tamano, filas, time of the prefix's last row)."""
    time_col = order[0]
    cutoffs = prefix_cutoffs(df, sizes, order, fractions)
    aggs, ends = [], []
    for i, c in enumerate(cutoffs):
        chosen = _selection(df, c, order)
        inside = F.lit(False)
        for condition in chosen.whole:
            inside = inside | F.coalesce(condition, F.lit(False))
        aggs += [F.count_if(inside).alias(f"f{i}"), F.max(F.when(inside, F.col(time_col))).alias(f"t{i}")]
        if chosen.last is not None and chosen.rest:
            ends.append(F.when(chosen.last, F.struct(F.lit(i).alias("i"), F.lit(chosen.rest).alias("rest"))))
    stacked = ", ".join(f"{i}, {c.size}L, f{i}, t{i}" for i, c in enumerate(cutoffs))
    counted = df.agg(*aggs).selectExpr(f"stack({len(cutoffs)}, {stacked}) AS (i, tamano, n, t)")
    if ends:
        # The few rows at each prefix's end are put in order; a prefix takes the first of them.
        at_end = df.select(*order, F.explode(F.array(*ends)).alias("end")).where("end IS NOT NULL")
        nth = F.row_number().over(Window.partitionBy("end.i").orderBy(*[F.col(c).asc_nulls_last() for c in order]))
        taken = at_end.withColumn("nth", nth).where("nth <= end.rest").groupBy(F.col("end.i").alias("i"))
        taken = taken.agg(F.lit(None).cast("bigint").alias("tamano"), F.count(F.lit(1)).alias("n"), F.max(time_col).alias("t"))
        counted = counted.unionByName(taken)
    return counted.groupBy("i").agg(F.max("tamano").alias("tamano"), F.sum("n").alias("filas"), F.max("t").alias("max_subida")).drop("i")
