from __future__ import annotations

import pytest

from conftest import raw_row, trips_frame
from tripgrid import schema as S
from tripgrid.operators.taxis import free_taxis, latest_per_key, taxi_state
from tripgrid.plans.profitable_areas import instant_query, profitable_areas, profitable_areas_seasonal, seasonal_query

AT = "2013-01-01 10:00"


def _state(spark, rows):
    state = instant_query(trips_frame(spark, rows), AT).state()
    return {r[S.MEDALLION]: r for r in state.collect()}


def test_taxi_state_cases(spark):
    rows = [
        # free: drop-off, no pickup in the window
        raw_row(medallon="nopick", pickup="2013-01-01 09:20:00", dropoff="2013-01-01 09:40:00"),
        # occupied: picked up again after the last drop-off
        raw_row(medallon="busy", pickup="2013-01-01 09:35:00", dropoff="2013-01-01 09:45:00"),
        raw_row(medallon="busy", pickup="2013-01-01 09:50:00", dropoff="2013-01-01 10:20:00"),
        # free: last pickup equal to last drop-off
        raw_row(medallon="equal", pickup="2013-01-01 09:35:00", dropoff="2013-01-01 09:45:00"),
        raw_row(medallon="equal", pickup="2013-01-01 09:45:00", dropoff="2013-01-01 10:30:00"),
        # absent: only a pickup in the window
        raw_row(medallon="onlyup", pickup="2013-01-01 09:55:00", dropoff="2013-01-01 10:30:00"),
        # the drop-off window is half-open: 09:30 exactly is out
        raw_row(medallon="edge", pickup="2013-01-01 09:10:00", dropoff="2013-01-01 09:30:00"),
    ]
    s = _state(spark, rows)
    assert set(s) == {"nopick", "busy", "equal"}
    assert s["nopick"].taxi_ocupado == 0 and s["nopick"][S.PICKUP_TIME] is None
    assert s["busy"].taxi_ocupado == 1
    assert s["equal"].taxi_ocupado == 0


def test_latest_per_key_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, 5, "x"), ("a", 3, 1, "y"), ("a", 3, 2, "z"), ("b", 2, 0, "w")],
        "key string, t int, tie int, payload string",
    )
    out = {r.key: r for r in latest_per_key(df, ["key"], "t", ["payload"], ["tie"]).collect()}
    assert (out["a"].t, out["a"].tie, out["a"].payload) == (3, 2, "z")
    assert out["b"].payload == "w"


def test_q2_benefit_divisor_and_missing_cells(spark):
    rows = [
        # benefit trips ending in (09:45, 10:00], by pickup cell (lon 150, lat 155) -> area (155, 150)
        raw_row(medallon="t1", pickup="2013-01-01 09:40:00", dropoff="2013-01-01 09:50:00",
                pickup_cell=(150, 155), dropoff_cell=(152, 157), fare="10.00", tip="2.00"),
        raw_row(medallon="t2", pickup="2013-01-01 09:41:00", dropoff="2013-01-01 09:52:00",
                pickup_cell=(150, 155), dropoff_cell=(151, 157), fare="20.00", tip="0.00"),
        # a free taxi in area (155, 150) that only counts for taxis, not benefit (ended at 09:40)
        raw_row(medallon="t3", pickup="2013-01-01 09:20:00", dropoff="2013-01-01 09:40:00",
                pickup_cell=(153, 159), dropoff_cell=(150, 155)),
    ]
    out = profitable_areas(trips_frame(spark, rows), AT).collect()
    got = {(r.cuad_latitud, r.cuad_longitud): r for r in out}
    # only the pickup cell with benefit appears; cells with only taxis do not
    assert set(got) == {(155, 150)}
    r = got[(155, 150)]
    assert r.beneficios == pytest.approx(1500.0 + 100.0)  # mean fare + mean tip, cents
    assert r.taxis_libres == 1
    assert r.beneficio == pytest.approx(1600.0 / 2)


def test_q2_no_free_taxi_divides_by_one(spark):
    rows = [raw_row(pickup="2013-01-01 09:40:00", dropoff="2013-01-01 09:50:00", fare="7.00", tip="0.50")]
    r = profitable_areas(trips_frame(spark, rows), AT).first()
    assert (r.taxis_libres, r.beneficio) == (0, pytest.approx(750.0))


def _seasonal_rows():
    # Tuesdays; reference 2013-03-19 10:00. Area (lat 155, lon 150) gets two free
    # taxis (a, b: drop-offs there) and two benefit trips (c, d: pickups there).
    near, far = "2013-03-19", "2013-02-12"  # far = 35 days before: outside every tier
    return [
        raw_row(medallon="a", pickup=f"{near} 09:35:00", dropoff=f"{near} 09:40:00",
                pickup_cell=(151, 156), dropoff_cell=(150, 155)),
        raw_row(medallon="b", pickup=f"{far} 09:35:00", dropoff=f"{far} 09:40:00",
                pickup_cell=(151, 156), dropoff_cell=(150, 155)),
        raw_row(medallon="c", pickup=f"{near} 09:46:00", dropoff=f"{near} 09:50:00",
                pickup_cell=(150, 155), dropoff_cell=(151, 156), fare="10.00", tip="0.00"),
        raw_row(medallon="d", pickup=f"{far} 09:46:00", dropoff=f"{far} 09:50:00",
                pickup_cell=(150, 155), dropoff_cell=(151, 156), fare="30.00", tip="0.00"),
    ]


def test_q2s_default(spark):
    r = profitable_areas_seasonal(trips_frame(spark, _seasonal_rows()), "martes", "03-19", "10:00").first()
    # benefit = (mean fare 2000 + mean tip 0) x mean influence (1.0 + 0.0)/2
    assert r.beneficios == pytest.approx(1000.0)
    # weighted free taxis = round(2 x 0.5) = 1 -> divisor 2
    assert r.proporcion_taxis_libres == 1.0
    assert r.beneficio == pytest.approx(500.0)


def test_q2s_compat(spark):
    r = profitable_areas_seasonal(
        trips_frame(spark, _seasonal_rows()), "martes", "03-19", "10:00", compat=True
    ).first()
    # NULL influences drop out of the means but not the counts
    assert r.beneficios == pytest.approx(2000.0 * 1.0)
    assert r.proporcion_taxis_libres == 2.0  # round(2 x 1.0)
    assert r.beneficio == pytest.approx(1000.0)


def test_q2s_zero_weighted_taxis(spark):
    rows = [
        raw_row(medallon="f1", pickup="2013-01-01 09:35:00", dropoff="2013-01-01 09:40:00",
                pickup_cell=(151, 156), dropoff_cell=(150, 155)),
        raw_row(medallon="f2", pickup="2013-01-01 09:46:00", dropoff="2013-01-01 09:50:00",
                pickup_cell=(150, 155), dropoff_cell=(151, 156)),
    ]
    t = trips_frame(spark, rows)
    got = {(r.cuad_latitud, r.cuad_longitud): r for r in profitable_areas_seasonal(t, "martes", "06-18", "10:00").collect()}
    r = got[(155, 150)]
    assert (r.proporcion_taxis_libres, r.beneficios, r.beneficio) == (0.0, 0.0, 0.0)
    compat = profitable_areas_seasonal(t, "martes", "06-18", "10:00", compat=True).collect()
    r = {(x.cuad_latitud, x.cuad_longitud): x for x in compat}[(155, 150)]
    assert r.beneficio is None  # all influences NULL -> no weighted count, no benefit


def test_q2s_state_per_date_vs_whole_year(spark):
    rows = [
        # Taxi t: free on 03-12 (drop-off 09:50, no later pickup that day) ...
        raw_row(medallon="t", pickup="2013-03-12 09:35:00", dropoff="2013-03-12 09:50:00", dropoff_cell=(151, 156)),
        # ... and on 03-19 picked up again after its drop-off: occupied that day
        raw_row(medallon="t", pickup="2013-03-19 09:35:00", dropoff="2013-03-19 09:40:00", dropoff_cell=(151, 156)),
        raw_row(medallon="t", pickup="2013-03-19 09:45:00", dropoff="2013-03-19 10:30:00", dropoff_cell=(151, 156)),
    ]
    t = trips_frame(spark, rows)
    state = seasonal_query(t, "martes", "03-19", "10:00").state()
    per_day = sorted((str(r.ocurrencia), r.taxi_ocupado) for r in state.collect())
    assert per_day == [("2013-03-12", 0), ("2013-03-19", 1)]
    state_c = seasonal_query(t, "martes", "03-19", "10:00", compat=True).state()
    whole = [(r.taxi_ocupado) for r in state_c.collect()]
    assert whole == [1]


def test_free_taxis_le_distinct_taxis(spark):
    rows = [
        raw_row(medallon=f"m{i % 7}", pickup=f"2013-01-01 09:{31 + i % 20}:00",
                dropoff=f"2013-01-01 09:{40 + i % 19}:00", dropoff_cell=(150 + i % 3, 156))
        for i in range(40)
    ]
    t = trips_frame(spark, rows)
    state = instant_query(t, AT).state()
    assert free_taxis(state).count() <= t.select(S.MEDALLION).distinct().count()


def test_taxi_state_occurrence_split(spark):
    """With occurrences, a trip can close one occurrence and open another."""
    from pyspark.sql import functions as F

    rows = [raw_row(medallon="x", pickup="2013-01-01 09:50:00", dropoff="2013-01-02 09:50:00")]
    t = trips_frame(spark, rows)
    down = F.lit(True)
    up = F.lit(True)
    occ = (F.to_date(S.DROPOFF_TIME), F.to_date(S.PICKUP_TIME))
    out = sorted((str(r.ocurrencia), r.taxi_ocupado) for r in taxi_state(t, down, up, occurrence=occ).collect())
    assert out == [("2013-01-02", 0)]


def test_in_use_flag_and_split_benefit(spark):
    from pyspark.sql import functions as F

    from tripgrid.functions.time import ts_literal
    from tripgrid.operators.areas import seasonal_area_benefit
    from tripgrid.operators.taxis import with_in_use_flag

    s = _state(spark, [
        raw_row(medallon="early", pickup="2013-01-01 09:35:00", dropoff="2013-01-01 09:45:00"),
        raw_row(medallon="late", pickup="2013-01-01 09:35:00", dropoff="2013-01-01 09:40:00"),
        raw_row(medallon="late", pickup="2013-01-01 10:00:00", dropoff="2013-01-01 10:20:00"),
    ])
    state = spark.createDataFrame([(m, r[S.PICKUP_TIME]) for m, r in s.items()], f"{S.MEDALLION} string, {S.PICKUP_TIME} timestamp_ntz")
    flags = {r[S.MEDALLION]: r.taxi_en_uso for r in with_in_use_flag(state, ts_literal("2013-01-01 10:00")).collect()}
    assert flags == {"early": 1, "late": 0}

    t = trips_frame(spark, _seasonal_rows())
    cells = seasonal_query(t, "martes", "03-19", "10:00").cells()
    split = seasonal_area_benefit(cells, split=True).where(F.col("cuad_latitud") == 155).first()
    joined = seasonal_area_benefit(cells).where(F.col("cuad_latitud") == 155).first()
    assert (split.beneficios, split.influencia) == (2000.0, 0.5)
    assert joined.beneficios == split.beneficios * split.influencia


def test_packed_and_struct_maximum_agree(spark):
    """The last drop-off packed into a long is the struct's maximum: fractions of seconds, ties, NULL cells, midnight."""
    import random

    from pyspark.sql import functions as F

    from tripgrid.operators.areas import taxi_state as state_of

    rng = random.Random(4)
    rows = [
        (f"T{rng.randint(0, 9)}", f"2013-01-01 {rng.choice(['23:50', '23:59', '00:05'])}:{rng.randint(0, 3):02d}.{rng.choice([0, 1, 999999]):06d}",
         rng.choice([None, 0, 1, 150, 300, 4094]), rng.choice([None, 1, 155, 301]))
        for _ in range(400)
    ]
    df = spark.createDataFrame(rows, f"{S.MEDALLION} string, t string, {S.DROPOFF_LAT_CELL} bigint, {S.DROPOFF_LON_CELL} bigint")
    df = df.selectExpr("*", f"CAST(t AS TIMESTAMP_NTZ) AS {S.DROPOFF_TIME}", f"CAST(t AS TIMESTAMP_NTZ) AS {S.PICKUP_TIME}",
                       *[f"CAST(NULL AS BIGINT) AS {c}" for c in S.PICKUP_CELL], f"CAST(1 AS DECIMAL(10,2)) AS {S.FARE}", f"CAST(1 AS DECIMAL(10,2)) AS {S.TIP}")
    occurrence = (F.to_date(S.DROPOFF_TIME), F.to_date(S.PICKUP_TIME))
    for kind in (df, df.withColumns({c: F.col(c).cast("timestamp") for c in (S.DROPOFF_TIME, S.PICKUP_TIME)})):
        dtype = kind.schema[S.DROPOFF_TIME].dataType.simpleString()
        args = (kind, F.lit(True), F.col(S.PICKUP_TIME) < F.lit("2013-01-01 12:00").cast(dtype), occurrence)
        packed = state_of(*args, base=lambda occ: f"CAST(date_sub({occ}, 1) AS {dtype})")
        plan = packed._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "HashAggregate" in plan
        assert sorted(map(str, packed.collect())) == sorted(map(str, state_of(*args).collect()))
    with pytest.raises(Exception, match="no cell of the grid"):
        state_of(df.withColumn(S.DROPOFF_LAT_CELL, F.lit(5000).cast("bigint")), F.lit(True), F.lit(False), base=lambda occ: "TIMESTAMP_NTZ '2013-01-01'").collect()


def test_amounts_in_currency_units(spark):
    from tripgrid.plans.profitable_areas import currency_units

    ranked = profitable_areas(trips_frame(spark, [raw_row(pickup="2013-01-01 09:40:00", dropoff="2013-01-01 09:50:00", fare="7.00", tip="0.50")]), AT)
    r = currency_units(ranked).first()
    assert (r.beneficios, r.beneficio, r.taxis_libres) == (7.5, 7.5, 0)
