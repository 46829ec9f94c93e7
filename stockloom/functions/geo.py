"""Distances and lane costs as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
EARTH_RADIUS_KM = 6371.0
LOCAL_LANE_COST = 20.0
MISSING_UNIT_LANE_COST = 5.0
TRANSPORT_SCALE = 0.1


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance between two points given in degrees."""
    north = F.pow(F.sin((F.radians(lat2) - F.radians(lat1)) / 2), F.lit(2.0))
    east = F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), F.lit(2.0))
    chord = north + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * east
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(F.lit(1.0), chord)))


def lane_cost(base: Column, distance: Column, longest: Column) -> Column:
    """Origin's mean shipping cost, scaled from one half (next door) to one (the longest lane)."""
    return base * (0.5 + 0.5 * F.try_divide(distance, longest))


def unit_lane_cost(lane: Column, same_store: Column) -> Column:
    """Cost of moving one unit: a tenth of the lane cost, 5 without a lane, 0 inside a store."""
    priced = F.coalesce(lane * TRANSPORT_SCALE, F.lit(MISSING_UNIT_LANE_COST))
    return F.when(same_store, F.lit(0.0)).otherwise(priced)
