"""Trip analytics on Spark: profiles, outliers, pair rankings and driver chains."""

from triploom.operators import *  # noqa: F403
from triploom.operators import __all__ as _operators
from triploom.schema import LOCATIONS_SCHEMA, TRIPS_SCHEMA, TripColumns
from triploom.sources import (
    read_edges,
    read_locations,
    read_stage,
    read_trips,
    read_vertices,
    write_csv,
    write_stage,
)

__all__ = [
    *_operators,
    "LOCATIONS_SCHEMA",
    "TRIPS_SCHEMA",
    "TripColumns",
    "read_edges",
    "read_locations",
    "read_stage",
    "read_trips",
    "read_vertices",
    "write_csv",
    "write_stage",
]
