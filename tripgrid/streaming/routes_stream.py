"""Frequent routes continuously: the instant query evaluated at every grid instant.

The batch query answers one instant ``t``: routes of trips whose pickup and
drop-off both lie in ``[t - w, t]``. Over a stream the same question is asked
at every ``t`` on a grid of step ``slide``. A trip counts at exactly the grid
instants in ``[max(pickup, dropoff), min(pickup, dropoff) + w]``, so each trip
is expanded to that short list (at most ``w / slide + 1`` instants), then
counted per (instant, route) as a streaming aggregation with partial
aggregation before the shuffle. The watermark on the instant closes an
instant once no later trip can still count there; in append mode each
instant is emitted once, final, and ``foreachBatch`` ranks it (an exact
two-stage top-k per instant).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..operators.topk import ranking_order

INSTANT = "instante"


def _require_utc(df: DataFrame) -> None:
    # Trip times are zone-less wall clock; instants are computed on the
    # microsecond line of a UTC session so no daylight-saving shift enters.
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"streaming routes need spark.sql.session.timeZone=UTC, got {zone}")


def _ntz_micros(c: Column) -> Column:
    """Microseconds since the epoch of a wall-clock time (UTC session)."""
    return F.unix_micros(c.cast("timestamp"))


def grid_instants(pickup: Column, dropoff: Column, window_minutes: int, slide_minutes: int) -> Column:
    """Array of the grid instants (multiples of ``slide``) at which a trip counts.

    A trip counts at ``t`` when both of its times are in ``[t - w, t]``, i.e.
    for ``t`` in ``[max(pickup, dropoff), min(pickup, dropoff) + w]``.
    """
    w_us = window_minutes * 60 * 1_000_000
    slide_us = slide_minutes * 60 * 1_000_000
    first_us = _ntz_micros(F.greatest(pickup, dropoff))
    last_us = _ntz_micros(F.least(pickup, dropoff)) + F.lit(w_us)
    # Round up / down to the grid with exact integer arithmetic.
    start = ((first_us + F.lit(slide_us - 1)) - F.pmod(first_us + F.lit(slide_us - 1), F.lit(slide_us))).cast("bigint")
    stop = (last_us - F.pmod(last_us, F.lit(slide_us))).cast("bigint")
    # Event-time watermarks need TIMESTAMP (not NTZ): instants are UTC timestamps.
    # A timestamp sequence with an interval step (no lambda, so it stays in codegen).
    step = F.expr(f"INTERVAL {int(slide_minutes)} MINUTES")
    return F.when(start <= stop, F.sequence(F.timestamp_micros(start), F.timestamp_micros(stop), step))


def route_counts_by_instant(
    trips: DataFrame, window_minutes: int = 30, slide_minutes: int = 5, watermark: str = "2 hours"
) -> DataFrame:
    """(instante, route) -> viajes over a streaming or batch trip frame.

    ``instante`` comes back as ``TIMESTAMP_NTZ`` like the trip times.
    """
    _require_utc(trips)
    expanded = trips.select(
        F.explode(grid_instants(F.col(S.PICKUP_TIME), F.col(S.DROPOFF_TIME), window_minutes, slide_minutes)).alias(
            INSTANT
        ),
        *S.ROUTE,
    )
    if trips.isStreaming:
        expanded = expanded.withWatermark(INSTANT, watermark)
    counts = expanded.groupBy(INSTANT, *S.ROUTE).agg(F.count(F.lit(1)).alias("viajes"))
    return counts.select(F.col(INSTANT).cast("timestamp_ntz").alias(INSTANT), *S.ROUTE, "viajes")


def rank_per_instant(counts: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` routes of every instant (rank 0..k-1, ties by route keys).

    The filter on the row number becomes a partial and a final group limit:
    each task hands on at most ``k`` routes of an instant, so no task ever
    ranks all routes of a busy one.
    """
    w = Window.partitionBy(INSTANT).orderBy(*ranking_order("viajes", S.ROUTE))
    ranked = counts.withColumn("_nth", F.row_number().over(w)).where(F.col("_nth") <= k)
    return ranked.select(INSTANT, (F.col("_nth") - 1).alias("rank"), *S.ROUTE, "viajes")


def frequent_routes_stream(
    trips: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint_location: str,
    window_minutes: int = 30,
    slide_minutes: int = 5,
    watermark: str = "2 hours",
    k: int = 10,
    available_now: bool = True,
):
    """Start a streaming query handing each batch of closed instants, ranked, to ``sink``.

    ``trips`` is a streaming processed-trip frame. Rows given to ``sink``:
    (instante, rank, 4 route cells, viajes). The watermark must cover the
    input's lateness plus the window.
    """
    counts = route_counts_by_instant(trips, window_minutes, slide_minutes, watermark)

    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        sink(rank_per_instant(batch, k), epoch_id)

    writer = (
        counts.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint_location)
        .foreachBatch(each_batch)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
