"""Reusable Column builders."""

from fleetframe.functions.buckets import bucket, distance_category, speed_category
from fleetframe.functions.calendar import (
    daynum_date, daynum_hour, daynum_minute, end_datetime_text, hour_cos, hour_sin,
    is_rush_hour, is_weekend, start_datetime_text,
)
from fleetframe.functions.geo import grid, haversine_km, route_key_columns
from fleetframe.functions.numeric import clean_numeric, guarded_ratio, safe_ratio

__all__ = [
    "bucket", "distance_category", "speed_category",
    "daynum_date", "daynum_hour", "daynum_minute", "end_datetime_text", "hour_cos", "hour_sin",
    "is_rush_hour", "is_weekend", "start_datetime_text",
    "grid", "haversine_km", "route_key_columns",
    "clean_numeric", "guarded_ratio", "safe_ratio",
]
