from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripgrid import schema as S  # noqa: E402
from tripgrid.functions.grid import LATITUDE_STEP, LONGITUDE_STEP, ORIGIN_LATITUDE, ORIGIN_LONGITUDE  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from tripgrid.session import local_session

    s = local_session(4, shuffle_partitions=4, checkpoint_dir=tempfile.mkdtemp(prefix="tripgrid-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tripgrid-test-")


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def lon_of(cell: int) -> Decimal:
    """Longitude of the centre of longitude cell ``cell`` (decimal(18,14))."""
    return (Decimal(str(ORIGIN_LONGITUDE)) + (Decimal(cell) - Decimal("0.5")) * Decimal(str(LONGITUDE_STEP))).quantize(
        Decimal("1e-14")
    )


def lat_of(cell: int) -> Decimal:
    return (Decimal(str(ORIGIN_LATITUDE)) - (Decimal(cell) - Decimal("0.5")) * Decimal(str(LATITUDE_STEP))).quantize(
        Decimal("1e-14")
    )


def raw_row(
    medallon="T1",
    licencia="L1",
    pickup="2013-01-01 09:40:00",
    dropoff="2013-01-01 09:50:00",
    duration=600,
    pickup_cell=(150, 155),
    dropoff_cell=(151, 156),
    payment="CSH",
    fare="10.00",
    tip="1.00",
    total=None,
    pickup_coord=None,
    dropoff_coord=None,
):
    """One raw trip; cells are (lon cell, lat cell)."""
    plon, plat = pickup_coord or (lon_of(pickup_cell[0]), lat_of(pickup_cell[1]))
    dlon, dlat = dropoff_coord or (lon_of(dropoff_cell[0]), lat_of(dropoff_cell[1]))
    fare_d, tip_d = Decimal(fare), Decimal(tip)
    total_d = Decimal(total) if total is not None else fare_d + tip_d
    return (
        medallon,
        licencia,
        ts(pickup) if isinstance(pickup, str) else pickup,
        ts(dropoff) if isinstance(dropoff, str) else dropoff,
        duration,
        Decimal("1.00"),
        plon,
        plat,
        dlon,
        dlat,
        payment,
        fare_d,
        Decimal("0.50"),
        Decimal("0.50"),
        tip_d,
        Decimal("0.00"),
        total_d,
    )


def raw_frame(spark, rows):
    return spark.createDataFrame(rows, S.RAW_SCHEMA)


def trips_frame(spark, rows):
    from tripgrid.operators.clean import process_trips

    return process_trips(raw_frame(spark, rows))
