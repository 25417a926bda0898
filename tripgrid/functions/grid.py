"""Grid cell functions (Column -> Column).

The city map is a square of GRID_SIZE x GRID_SIZE cells of 0.5 km. Cell (1, 1)
is the north-west corner; x grows east (longitude), y grows south (latitude).
Arithmetic is done in double, as in the original application, so cell numbers
computed here equal the ones already stored in existing processed tables.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the original grid exactly:
# cell height in degrees of latitude, cell width in degrees of longitude,
# cells per side, north-west origin corner (lat, lon), south-east far corner (lat, lon).
LATITUDE_STEP = 0.004491556
LONGITUDE_STEP = 0.005986
GRID_SIZE = 300
ORIGIN_LATITUDE = 41.477182778
ORIGIN_LONGITUDE = -74.916578
FAR_LATITUDE = 40.129715978
FAR_LONGITUDE = -73.120778


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lat_cell(lat: Column | str) -> Column:
    """Latitude cell number (y, grows south): floor((lat0 - lat) / dlat) + 1."""
    return F.floor((F.lit(ORIGIN_LATITUDE) - _col(lat).cast("double")) / F.lit(LATITUDE_STEP)) + 1


def lon_cell(lon: Column | str) -> Column:
    """Longitude cell number (x, grows east): floor(|lon0 - lon| / dlon) + 1."""
    return (
        F.floor(F.abs(F.lit(ORIGIN_LONGITUDE) - _col(lon).cast("double")) / F.lit(LONGITUDE_STEP))
        + 1
    )


def cell_corner_lat(y: Column | str) -> Column:
    """Latitude of the north-west corner of latitude cell ``y``."""
    return F.lit(ORIGIN_LATITUDE) - (_col(y) - 1).cast("double") * F.lit(LATITUDE_STEP)


def cell_corner_lon(x: Column | str) -> Column:
    """Longitude of the north-west corner of longitude cell ``x``."""
    return F.lit(ORIGIN_LONGITUDE) + (_col(x) - 1).cast("double") * F.lit(LONGITUDE_STEP)


def in_grid(*cells: Column | str, size: int = GRID_SIZE) -> Column:
    """True when every given cell number lies in 1..size."""
    cond = F.lit(True)
    for c in cells:
        cond = cond & _col(c).between(1, size)
    return cond
