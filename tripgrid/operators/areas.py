"""Taxis and benefit of areas from one scan of the trips.

A trip yields up to three tagged events: the drop-off and the pickup of its
taxi, and the benefit of its pickup cell. One aggregate, keyed by taxi for the
first two and by cell for the third, reduces them before the exchange; a second
one, by cell, puts free taxis and benefit together. So a plan has one scan, two
exchanges, no join, and its size after the first exchange is one row per taxi
and cell.

The latest drop-off of a taxi is a maximum. Where the times of an occurrence
span less than ``TIME_BITS`` of microseconds, time and cell are packed into one
long whose order is theirs, so the maximum has a buffer of fixed width and the
aggregate stays a hash aggregate. Tie-break columns, and times without a bound,
take the maximum of a struct instead, which Spark computes by sorting.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S

TIME_BITS = 38  # three days of microseconds
CELL_BITS = 12
_LAST_CELL = (1 << CELL_BITS) - 2

Base = Callable[[str], str]


def packable(minutes: float) -> bool:
    """Whether drop-off times within so many minutes can be packed."""
    return 0 <= minutes * 60_000_000 < 1 << TIME_BITS


def _cell_sql(column: str) -> str:
    return (
        f"CASE WHEN {column} IS NULL THEN 0L WHEN {column} BETWEEN 0 AND {_LAST_CELL} THEN CAST({column} AS BIGINT) + 1 "
        f"ELSE CAST(raise_error('{column} is no cell of the grid') AS BIGINT) END"
    )


def pack_latest_sql(time: str, base: str, lat: str, lon: str) -> str:
    """A long ordered like (time, lat, lon), NULL cells first; times lie at most ``TIME_BITS`` after ``base``."""
    offset = f"shiftleft(timestampdiff(MICROSECOND, {base}, {time}), {2 * CELL_BITS})"
    return f"({offset} | shiftleft({_cell_sql(lat)}, {CELL_BITS}) | ({_cell_sql(lon)}))"


def unpack_latest_sql(packed: str, base: str) -> tuple[str, str, str]:
    """SQL of the time and the two cells of a packed long."""
    mask = (1 << CELL_BITS) - 1
    time = f"timestampadd(MICROSECOND, shiftright({packed}, {2 * CELL_BITS}), {base})"
    lat, lon = f"nullif(shiftright({packed}, {CELL_BITS}) & {mask}L, 0L) - 1", f"nullif({packed} & {mask}L, 0L) - 1"
    return f"CASE WHEN {packed} IS NOT NULL THEN {time} END", lat, lon


def _struct_sql(tiebreak: Sequence[str]) -> str:
    fields = [S.DROPOFF_TIME, *[c for c in tiebreak if c != S.MEDALLION], S.DROPOFF_LAT_CELL, S.DROPOFF_LON_CELL]
    return "named_struct(" + ", ".join(f"'{c}', {c}" for c in fields) + ")"


_NONE = Column | None


def tagged_events(
    trips: DataFrame,
    down: _NONE = None,
    up: _NONE = None,
    benefit: _NONE = None,
    occurrence: tuple[Column, Column] | None = None,
    influence: _NONE = None,
    tiebreak: Sequence[str] = (),
    base: Base | None = None,
) -> DataFrame:
    """The events of the trips, aggregated by (tag, taxi and occurrence or cell).

    ``down``, ``up`` and ``benefit`` tell which trips count as what;
    ``occurrence`` = (key of a drop-off, key of a pickup) splits a taxi's
    history; ``base`` gives the SQL of the time from which an occurrence's
    drop-offs are counted (from the name of its key column), None where they
    cannot be packed. Tag 0 rows hold ``last`` (packed or struct) and ``pick``
    of a taxi, tag 1 rows the sums of a cell.
    """
    no = F.lit(False)
    flags = {"_down": no if down is None else down, "_up": no if up is None else up, "_benefit": no if benefit is None else benefit}
    flags["_infl"] = F.lit(None).cast("double") if influence is None else influence.cast("double")
    for name, column in zip(("_occ_down", "_occ_up"), occurrence or (F.lit(None).cast("date"),) * 2, strict=True):
        flags[name] = column
    if tiebreak or base is None:
        last = _struct_sql(tiebreak)
    else:
        last = pack_latest_sql(S.DROPOFF_TIME, base("_occ_down"), S.DROPOFF_LAT_CELL, S.DROPOFF_LON_CELL)
    null = {
        "taxi": "CAST(NULL AS STRING)",
        "occ": "CAST(NULL AS DATE)",
        "lat": "CAST(NULL AS BIGINT)",
        "lon": "CAST(NULL AS BIGINT)",
        "last": f"CASE WHEN false THEN {last} END",
        "pick": f"CASE WHEN false THEN {S.PICKUP_TIME} END",
        "fare": "CAST(NULL AS BIGINT)",
        "tip": "CAST(NULL AS BIGINT)",
        "infl": "CAST(NULL AS DOUBLE)",
    }

    def event(when: str, tag: int, **fields: str) -> str:
        values = ", ".join(f"'{name}', {sql}" for name, sql in {"tag": str(tag), **null, **fields}.items())
        return f"CASE WHEN {when} THEN named_struct({values}) END"

    events = [
        event("_down", 0, taxi=S.MEDALLION, occ="_occ_down", last=last),
        event("_up", 0, taxi=S.MEDALLION, occ="_occ_up", pick=S.PICKUP_TIME),
        event(
            "_benefit",
            1,
            lat=S.PICKUP_LAT_CELL,
            lon=S.PICKUP_LON_CELL,
            fare=f"CAST({S.FARE} * 100 AS BIGINT)",
            tip=f"CAST({S.TIP} * 100 AS BIGINT)",
            infl="_infl",
        ),
    ]
    used = [e for e, given in zip(events, (down, up, benefit), strict=True) if given is not None]
    # The predicates are deterministic, so the filter still reaches the scan.
    rows = trips.withColumns(flags).where("_down OR _up OR _benefit")
    # A plain explode and a null filter (no higher-order function) keep the Generate in codegen.
    exploded = rows.selectExpr(f"explode(array({', '.join(used)})) AS e").where("e IS NOT NULL").select("e.*")
    return exploded.groupBy("tag", "taxi", "occ", "lat", "lon").agg(
        F.max("last").alias("last"),
        F.max("pick").alias("pick"),
        F.count(F.lit(1)).alias("n"),
        F.sum("fare").alias("fare"),
        F.count("fare").alias("n_fare"),
        F.sum("tip").alias("tip"),
        F.count("tip").alias("n_tip"),
        F.sum("infl").alias("infl"),
        F.count("infl").alias("n_infl"),
    )


def _with_last(events: DataFrame, tiebreak: Sequence[str], base: Base | None) -> DataFrame:
    """Events with the time and cells of ``last`` as columns of their own."""
    if tiebreak or base is None:
        found = tuple(f"last.{c}" for c in (S.DROPOFF_TIME, S.DROPOFF_LAT_CELL, S.DROPOFF_LON_CELL))
    else:
        found = unpack_latest_sql("last", base("occ"))
    names = (S.DROPOFF_TIME, S.DROPOFF_LAT_CELL, S.DROPOFF_LON_CELL)
    return events.selectExpr("*", *[f"{sql} AS {name}" for sql, name in zip(found, names, strict=True)])


def taxi_state(
    trips: DataFrame,
    down: Column,
    up: Column,
    occurrence: tuple[Column, Column] | None = None,
    tiebreak: Sequence[str] = (),
    base: Base | None = None,
) -> DataFrame:
    """Per taxi: last drop-off (time and cell) under ``down``, last pickup under ``up``.

    ``occurrence`` = (key of a drop-off row, key of a pickup row) splits each
    taxi's history into separate occurrences (one per date in the seasonal
    query); without it the whole input is one occurrence.

    Output: ``medallon``, [``ocurrencia``], ``hora_bajada``, ``cuad_latitud_bajada``,
    ``cuad_longitud_bajada``, ``hora_subida`` (last pickup, NULL if none),
    ``taxi_ocupado`` (1 when the last pickup is strictly after the last
    drop-off, else 0). Taxis with no drop-off under ``down`` are absent.
    """
    events = tagged_events(trips, down, up, occurrence=occurrence, tiebreak=tiebreak, base=base)
    state = _with_last(events.where("last IS NOT NULL"), tiebreak, base)
    return state.selectExpr(
        f"taxi AS {S.MEDALLION}",
        *(["occ AS ocurrencia"] if occurrence is not None else []),
        S.DROPOFF_TIME,
        S.DROPOFF_LAT_CELL,
        S.DROPOFF_LON_CELL,
        f"pick AS {S.PICKUP_TIME}",
        f"CAST(CASE WHEN pick > {S.DROPOFF_TIME} THEN 1 ELSE 0 END AS INT) AS taxi_ocupado",
    )


def area_cells(
    trips: DataFrame,
    down: _NONE = None,
    up: _NONE = None,
    benefit: _NONE = None,
    occurrence: tuple[Column, Column] | None = None,
    influence: _NONE = None,
    tiebreak: Sequence[str] = (),
    base: Base | None = None,
) -> DataFrame:
    """Per cell: trips with benefit and free taxis (see :func:`tagged_events` for the arguments).

    Columns: ``cuad_latitud``, ``cuad_longitud``, ``n_viajes``,
    ``media_tarifa``, ``media_propina`` (cents, double), ``influencia_viajes``,
    ``taxis_libres``, ``influencia_taxis``. A mean without values is NULL.
    """
    events = tagged_events(trips, down, up, benefit, occurrence, influence, tiebreak, base)
    placed = _with_last(events, tiebreak, base)
    free = placed.where(f"tag = 1 OR (last IS NOT NULL AND NOT coalesce(pick > {S.DROPOFF_TIME}, false))")
    weight = F.lit(None).cast("double") if influence is None else influence.cast("double")
    rows = free.withColumn("weight", F.when(F.col("tag") == 0, weight)).selectExpr(
        f"CASE WHEN tag = 1 THEN lat ELSE {S.DROPOFF_LAT_CELL} END AS {S.AREA[0]}",
        f"CASE WHEN tag = 1 THEN lon ELSE {S.DROPOFF_LON_CELL} END AS {S.AREA[1]}",
        "CASE WHEN tag = 1 THEN n ELSE 0L END AS n_viajes",
        "CASE WHEN tag = 1 THEN 0L ELSE 1L END AS n_libres",
        "fare",
        "n_fare",
        "tip",
        "n_tip",
        "infl",
        "n_infl",
        "weight",
    )
    mean = "try_divide(CAST(sum({0}) AS DOUBLE), CAST(sum(n_{0}) AS DOUBLE))"
    return rows.groupBy(*S.AREA).agg(
        F.sum("n_viajes").alias("n_viajes"),
        F.expr(mean.format("fare")).alias("media_tarifa"),
        F.expr(mean.format("tip")).alias("media_propina"),
        F.expr(mean.format("infl")).alias("influencia_viajes"),
        F.sum("n_libres").alias("taxis_libres"),
        F.avg("weight").alias("influencia_taxis"),
    )


# Measures of a cell, shared by the queries and by the operators below.
BENEFIT_SQL = "media_tarifa + media_propina"
SEASONAL_BENEFIT_SQL = f"({BENEFIT_SQL}) * influencia_viajes"
# No free taxi in the cell gives NULL, as an outer join would.
WEIGHTED_FREE_SQL = "round(CASE WHEN taxis_libres > 0 THEN taxis_libres * influencia_taxis END)"


def with_benefit(cells: DataFrame) -> DataFrame:
    """The cells that have trips with benefit."""
    return cells.where("n_viajes > 0")


def area_benefit(cells: DataFrame) -> DataFrame:
    """Per pickup cell: ``beneficios = mean(fare) + mean(tip)`` (cents)."""
    return with_benefit(cells).selectExpr(*S.AREA, f"{BENEFIT_SQL} AS beneficios")


def seasonal_area_benefit(cells: DataFrame, split: bool = False) -> DataFrame:
    """Per pickup cell: ``(mean(fare) + mean(tip)) x mean(influence)`` (cents).

    A product of means, not a mean of products: that is the definition the
    seasonal query uses. ``split`` returns the two factors instead:
    ``beneficios = mean(fare) + mean(tip)`` and ``influencia = mean(influence)``.
    """
    if split:
        return with_benefit(cells).selectExpr(*S.AREA, f"{BENEFIT_SQL} AS beneficios", "influencia_viajes AS influencia")
    return with_benefit(cells).selectExpr(*S.AREA, f"{SEASONAL_BENEFIT_SQL} AS beneficios")


def _dropoff_cell_sql() -> list[str]:
    return [f"{a} AS {c}" for a, c in zip(S.AREA, S.DROPOFF_CELL, strict=True)]


def free_taxis_per_cell(cells: DataFrame) -> DataFrame:
    """Free taxis per drop-off cell (``taxis_libres``)."""
    return cells.where("taxis_libres > 0").selectExpr(*_dropoff_cell_sql(), "taxis_libres")


def weighted_free_taxis(cells: DataFrame) -> DataFrame:
    """Per drop-off cell: ``round(count x mean(influence))``.

    NULL influences are left out of the mean but not of the count, as in the
    original; a cell whose influences are all NULL gets NULL.
    """
    return cells.where("taxis_libres > 0").selectExpr(
        *_dropoff_cell_sql(), "taxis_libres", "influencia_taxis AS influencia", f"{WEIGHTED_FREE_SQL} AS proporcion_taxis_libres"
    )
