"""Great-circle distance and the coordinate grid used for routes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fleetframe.functions.numeric import _c

# Fixed value: mean Earth radius in km used for trip distances.
EARTH_RADIUS_KM = 6371.0
# Fixed value: decimals kept when snapping coordinates to the route grid.
ROUTE_GRID_DECIMALS = 2


def haversine_km(lat1, lon1, lat2, lon2, scale: int = 2) -> Column:
    """Haversine distance in km between two fixes, rounded to ``scale``.

    ``a`` is clamped to at most 1 so floating error near antipodal points
    cannot produce sqrt of a negative number; a missing coordinate gives NULL.
    """
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    dlat = F.radians(lat2 - lat1)
    dlon = F.radians(lon2 - lon1)
    half_dlat = F.sin(dlat / 2)
    half_dlon = F.sin(dlon / 2)
    a = half_dlat * half_dlat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_dlon * half_dlon
    a = F.when(a > 1.0, F.lit(1.0)).otherwise(a)  # (least() would turn NULL into 1.0)
    c = F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a)) * 2
    return F.round(c * EARTH_RADIUS_KM, scale)


def grid(x) -> Column:
    """Snap a coordinate to the route grid (~1 km in degrees, not equal-area)."""
    return F.round(_c(x), ROUTE_GRID_DECIMALS)


def route_key_columns(origin_lat="origin_lat", origin_lon="origin_lon",
                      dest_lat="destination_lat", dest_lon="destination_lon") -> dict[str, Column]:
    return {
        "origin_lat_rounded": grid(origin_lat),
        "origin_lon_rounded": grid(origin_lon),
        "dest_lat_rounded": grid(dest_lat),
        "dest_lon_rounded": grid(dest_lon),
    }
