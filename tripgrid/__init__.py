"""tripgrid: trip-log analytics on Spark DataFrames.

Raw trip records are cleaned, snapped to a fixed 300 x 300 city grid and stored
as Parquet; ranked questions (frequent routes, profitable areas and their
seasonal forms) are lazy DataFrame plans over that table.

The main entry points are re-exported here; see the subpackages for the rest.
"""

from .operators.clean import clean_report, clean_trips, process_trips
from .plans.frequent_routes import frequent_routes, frequent_routes_seasonal
from .plans.profitable_areas import profitable_areas, profitable_areas_seasonal
from .sources.trip_store import compact_trips, index_trips
from .sources.trips_io import open_trips, read_raw_trips, read_trips, read_trips_table, write_trips

__version__ = "0.1.0"

__all__ = [
    "clean_report",
    "clean_trips",
    "compact_trips",
    "frequent_routes",
    "frequent_routes_seasonal",
    "index_trips",
    "open_trips",
    "process_trips",
    "profitable_areas",
    "profitable_areas_seasonal",
    "read_raw_trips",
    "read_trips",
    "read_trips_table",
    "write_trips",
]
