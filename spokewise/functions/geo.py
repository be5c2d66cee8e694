"""Great-circle distance from built-in math (F3); no Python UDF."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from spokewise.functions._util import col

# fixed value: mean Earth radius in km used for the distance
EARTH_RADIUS_KM = 6371.0


def haversine(lat1, lon1, lat2, lon2) -> Column:
    """Distance in km between two points given in degrees."""
    p1, p2 = F.radians(col(lat1)), F.radians(col(lat2))
    dphi = F.radians(col(lat2) - col(lat1))
    dlmb = F.radians(col(lon2) - col(lon1))
    h = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(h))
