from __future__ import annotations

from decimal import Decimal

from conftest import lat_of, lon_of, raw_frame, raw_row
from tripgrid import schema as S
from tripgrid.operators.clean import clean_report, clean_trips, process_trips


def _kept(spark, rows, **kw):
    return [r[S.MEDALLION] for r in clean_trips(raw_frame(spark, rows), **kw).collect()]


def test_rules_one_by_one(spark):
    rows = [
        raw_row(medallon="ok"),
        raw_row(medallon=""),
        raw_row(medallon=None),
        raw_row(medallon="nolic", licencia=""),
        raw_row(medallon="sametime", dropoff="2013-01-01 09:40:00"),
        raw_row(medallon="zerodur", duration=0),
        raw_row(medallon="zerototal", total="0.00"),
        raw_row(medallon="samelon", dropoff_cell=(150, 156)),
        raw_row(medallon="samelat", dropoff_cell=(151, 155)),
        raw_row(medallon="still", dropoff_cell=(150, 155)),
        raw_row(medallon="chs", payment="CHS"),
        raw_row(medallon="unk", payment="UNK"),
        raw_row(medallon="crd", payment="CRD"),
        raw_row(medallon="nullpay", payment=None),
        raw_row(medallon="outside", pickup_coord=(Decimal("0"), lat_of(155))),
    ]
    assert sorted(_kept(spark, rows)) == ["crd", "ok"]
    # Only an unmoved trip fails the looser "any coordinate differs" rule.
    assert sorted(_kept(spark, rows, moved_mode="any_differs")) == ["crd", "ok", "samelat", "samelon"]


def test_box_edges_inclusive(spark):
    lo_lon, hi_lon = Decimal("-74.916578"), Decimal("-73.120778")
    lo_lat, hi_lat = Decimal("40.129715978"), Decimal("41.477182778")
    rows = [
        raw_row(medallon="nw", pickup_coord=(lo_lon, hi_lat)),
        raw_row(medallon="se", pickup_coord=(hi_lon, lo_lat)),
        raw_row(medallon="past_e", pickup_coord=(hi_lon + Decimal("1e-6"), lat_of(155))),
        raw_row(medallon="past_n", pickup_coord=(lon_of(150), hi_lat + Decimal("1e-6"))),
    ]
    assert sorted(_kept(spark, rows)) == ["nw", "se"]
    # The far edge maps to longitude cell 301: dropped by default, kept in compat.
    default = process_trips(raw_frame(spark, rows))
    assert sorted(r[S.MEDALLION] for r in default.collect()) == ["nw"]
    compat = process_trips(raw_frame(spark, rows), compat=True)
    cells = {r[S.MEDALLION]: (r[S.PICKUP_LON_CELL], r[S.PICKUP_LAT_CELL]) for r in compat.collect()}
    assert cells == {"nw": (1, 1), "se": (301, 300)}


def test_processed_columns(spark):
    out = process_trips(raw_frame(spark, [raw_row(pickup_cell=(150, 155), dropoff_cell=(152, 158))]))
    assert tuple(out.columns) == S.PROCESSED_COLUMNS
    r = out.first()
    assert (r.cuad_longitud_subida, r.cuad_latitud_subida) == (150, 155)
    assert (r.cuad_longitud_bajada, r.cuad_latitud_bajada) == (152, 158)
    assert r.dia_semana == 1  # 2013-01-01 was a Tuesday
    assert dict(out.dtypes)[S.PICKUP_LAT_CELL] == "bigint"


def test_clean_report(spark):
    rows = [
        raw_row(),
        raw_row(medallon=""),
        raw_row(payment="UNK", duration=0),
        raw_row(dropoff_cell=(150, 155)),
    ]
    r = clean_report(raw_frame(spark, rows)).first().asDict()
    assert r == {
        "n_raw": 4,
        "fail_ids": 1,
        "fail_times": 0,
        "fail_positive": 1,
        "fail_moved": 1,
        "fail_payment": 1,
        "fail_box": 0,
        "fail_grid": 0,
        "n_clean": 1,
    }
