"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_column

# Earth radius in miles, kilometres per mile.
EARTH_RADIUS_MILES = 3961
UNITS = {"mi": 1.0, "km": 1.60934}


def haversine_distance(
    lat1: str | Column, lon1: str | Column, lat2: str | Column, lon2: str | Column, unit: str = "mi"
) -> Column:
    """Distance between two points given in degrees, in miles or kilometres."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {sorted(UNITS)}, got {unit!r}")
    lat1, lon1, lat2, lon2 = map(as_column, (lat1, lon1, lat2, lon2))

    def half_chord(a: Column, b: Column) -> Column:
        return F.pow(F.sin(F.radians((b - a) / 2)), F.lit(2.0))

    chord = half_chord(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_chord(lon1, lon2)
    # rounding can lift the chord of opposite points just above 1
    angle = F.asin(F.sqrt(F.least(F.lit(1.0), chord)))
    return F.lit(2 * EARTH_RADIUS_MILES * UNITS[unit]) * angle
