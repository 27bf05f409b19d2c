"""Distance on a sphere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius in miles and degrees per radian.
EARTH_RADIUS_MILES = 3963.1676
DEGREES_PER_RADIAN = 57.29577951


def great_circle_miles(
    lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column, literal: bool = False
) -> Column:
    """Spherical law of cosines on inputs rounded to 5 places, result rounded to 1.

    The cosine is clamped to [-1, 1]: identical points can give a value just above 1.
    ``literal`` truncates to whole miles.
    """

    def radians(degrees: Column) -> Column:
        return F.round(degrees, 5) / DEGREES_PER_RADIAN

    turn = (F.round(lon_a, 5) - F.round(lon_b, 5)) / DEGREES_PER_RADIAN
    cosine = F.sin(radians(lat_a)) * F.sin(radians(lat_b)) + F.cos(radians(lat_a)) * F.cos(
        radians(lat_b)
    ) * F.cos(turn)
    cosine = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))
    miles = F.round(F.acos(cosine) * EARTH_RADIUS_MILES, 1)
    return F.floor(miles).cast("int") if literal else miles
