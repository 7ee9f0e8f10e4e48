"""Point-in-time feature table for energy prediction (one row per trip).

History features only look at trips that came *before* the current one:
vehicle history orders a vehicle's trips by absolute day then trip number,
route history orders a route's trips by day, vehicle and trip.  Both use the
skew-safe trailing operator.  The fleet mean is a one-value aggregate used as
a scalar subquery (no single-partition window, no cross join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetframe.functions.buckets import distance_category, speed_category
from fleetframe.functions.exact import SQUARE_PARTS, WIDE, mean_of, rounded_mean_of, unit_values, units, with_stddev
from fleetframe.functions.calendar import hour_cos, hour_sin, is_rush_hour, is_weekend
from fleetframe.functions.numeric import guarded_ratio
from fleetframe.operators.aggregates import with_route_key
from fleetframe.operators.history import key_profiles, trailing_sums
from fleetframe.schema import FEATURE_COLUMNS, ROUTE_KEYS
from fleetframe.session import materialize

# History depth (rows) and the minimum history for a training row.
VEHICLE_FRAME = 30
ROUTE_FRAME = 10
MIN_VEHICLE_TRIPS = 5
MIN_ROUTE_TRIPS = 1

VEHICLE_ORDER = ["DayNum", "Trip"]
ROUTE_ORDER = ["DayNum", "VehId", "Trip"]


def _history(df, keys, order, frame, values, chunks, skew_safe, profile=None):
    """Trailing sums per key, those of units in decimals (a running total spans all trips
    of a key); ``skew_safe=False`` skips measuring and splitting keys."""
    wide = {name for name in values if name.startswith("_") and not name.endswith("_n")}
    if skew_safe:
        return trailing_sums(df, keys, order, frame, values, wide, chunks=chunks, profile=profile)
    return trailing_sums(df, keys, order, frame, values, wide, profile=(0, 0))


def _frame_values(tag: str, column: str, scale: int, squares: bool = False) -> dict[str, Column]:
    return {f"{tag}_{k}": v for k, v in unit_values(column, scale, squares=squares).items()}


def _present(column: str) -> Column:
    return F.when(F.col(column).isNotNull(), F.lit(1)).otherwise(F.lit(0))


def _parts(tag: str):
    return F.col(f"{tag}_s"), F.col(f"{tag}_n")


def _drop_parts(df: DataFrame, *tags: str) -> DataFrame:
    return df.drop(*[c for c in df.columns if any(c.startswith(t + "_") for t in tags)])


def vehicle_history(trips: DataFrame, chunks: int | None = None, skew_safe: bool = True,
                    profile: tuple[int, int] | None = None) -> DataFrame:
    """Previous 30 trips of the same vehicle (by day, then trip number)."""
    values = {**_frame_values("_ve", "efficiency_km_per_energy", 4),
              **_frame_values("_vn", "total_energy_consumption", 2, squares=True),
              **_frame_values("_vd", "distance_km", 2),
              "vehicle_trip_count_last30": _present("Trip")}
    out = _history(trips, ["VehId"], VEHICLE_ORDER, VEHICLE_FRAME, values, chunks, skew_safe, profile)
    (es, en), (ns, nn), (ds, dn) = _parts("_ve"), _parts("_vn"), _parts("_vd")
    squares = F.struct(*[F.col(f"_vn_{k}").alias(k) for k in SQUARE_PARTS])
    out = with_stddev(out, "vehicle_stddev_energy_last30", ns, squares, nn, 2)
    out = out.withColumns({
        "vehicle_avg_efficiency_last30": rounded_mean_of(es, en, 4, 4),
        "vehicle_avg_energy_last30": rounded_mean_of(ns, nn, 2, 2),
        "vehicle_stddev_energy_last30": F.round("vehicle_stddev_energy_last30", 2),
        "vehicle_avg_distance_last30": rounded_mean_of(ds, dn, 2, 2),
    })
    return _drop_parts(out, "_ve", "_vn", "_vd")


def route_history(trips: DataFrame, chunks: int | None = None, skew_safe: bool = True,
                  profile: tuple[int, int] | None = None) -> DataFrame:
    """Previous 10 trips on the same rounded route (by day, vehicle, trip).
    Needs the route key columns (``with_route_key``)."""
    values = {**_frame_values("_rn", "total_energy_consumption", 2),
              **_frame_values("_rd", "duration_minutes", 2),
              **_frame_values("_rs", "avg_speed_kmh", 2),
              "route_trip_count": _present("Trip")}
    out = _history(trips, ROUTE_KEYS, ROUTE_ORDER, ROUTE_FRAME, values, chunks, skew_safe, profile)
    (ns, nn), (ds, dn), (ss, sn) = _parts("_rn"), _parts("_rd"), _parts("_rs")
    out = out.withColumns({
        "route_avg_energy_last10": rounded_mean_of(ns, nn, 2, 2),
        "route_avg_duration_last10": rounded_mean_of(ds, dn, 2, 2),
        "route_avg_speed_last10": rounded_mean_of(ss, sn, 2, 2),
    })
    return _drop_parts(out, "_rn", "_rd", "_rs")


def interaction_columns() -> dict[str, Column]:
    """Distance x elevation, speed squared and per distance, duration per distance, speed spread."""
    d, sp = F.col("distance_km"), F.col("avg_speed_kmh")
    return {
        "distance_elevation_interaction": F.round(d * F.col("elevation_gain_m"), 2),
        "speed_squared": F.round(F.pow(sp, 2), 2),
        "speed_per_distance": guarded_ratio(F.pow(sp, 2), d, 2),
        "duration_per_distance": guarded_ratio("duration_minutes", d, 4),
        "speed_variability": F.round(F.col("max_speed_kmh") - sp, 2),
    }


def ratio_columns() -> dict[str, Column]:
    """Elevation gradient, speed from distance and duration, mean-to-max speed."""
    return {
        "elevation_gradient": guarded_ratio("elevation_gain_m", "distance_km", 4),
        "actual_speed_efficiency": guarded_ratio(F.col("distance_km") * 60, "duration_minutes", 2),
        "speed_efficiency_ratio": guarded_ratio("avg_speed_kmh", "max_speed_kmh", 4),
    }


def battery_columns() -> dict[str, Column]:
    """State-of-charge range and use per minute, energy per km."""
    soc_range = F.col("max_battery_soc") - F.col("min_battery_soc")
    return {
        "battery_soc_range": F.round(soc_range, 2),
        "battery_usage_rate": guarded_ratio(soc_range, "duration_minutes", 4),
        # derived from the target: listed in schema.POST_TRIP_COLUMNS
        "energy_per_km": guarded_ratio("total_energy_consumption", "distance_km", 4),
    }


def complexity_columns() -> dict[str, Column]:
    """Needs ``speed_variability`` and ``elevation_gradient`` (rounded) first."""
    return {
        "elevation_per_minute": guarded_ratio("elevation_gain_m", "duration_minutes", 4),
        "trip_complexity_score": F.round(F.col("speed_variability") / 10.0
                                         + F.col("elevation_gradient") * 100, 2),
    }


def time_columns() -> dict[str, Column]:
    """Rush hour and weekend flags, cyclic hour of day."""
    return {
        "is_rush_hour": is_rush_hour("trip_hour"),
        "is_weekend": is_weekend("trip_dayofweek"),
        "hour_sin": hour_sin("trip_hour"),
        "hour_cos": hour_cos("trip_hour"),
    }


def category_columns() -> dict[str, Column]:
    """Distance and speed buckets (NULL falls into the top bucket)."""
    return {
        "distance_category": distance_category("distance_km"),
        "speed_category": speed_category("avg_speed_kmh"),
    }


def engineered(df: DataFrame) -> DataFrame:
    """All per-trip engineered columns (two projections: complexity uses rounded inputs)."""
    first = {**interaction_columns(), **ratio_columns(), **battery_columns(),
             **time_columns(), **category_columns()}
    return df.withColumns(first).withColumns(complexity_columns())


def history_stage(trips: DataFrame, chunks: int | None = None, skew_safe: bool = True) -> DataFrame:
    """Route key, vehicle and route history, engineered columns (all trips).

    ``trips`` should be a scan of written data: key sizes are measured on it
    (one job, two small aggregates) before the windows are planned."""
    keyed = with_route_key(trips)
    profiles = key_profiles(keyed, {"vehicle": ["VehId"], "route": ROUTE_KEYS}) if skew_safe else {}
    vehicles = vehicle_history(keyed, chunks, skew_safe, profiles.get("vehicle"))
    return engineered(route_history(vehicles, chunks, skew_safe, profiles.get("route")))


def with_fleet_comparison(hist: DataFrame) -> DataFrame:
    """``vehicle_efficiency_vs_fleet``: own 30-trip efficiency minus the fleet mean
    of that column over all trips (before the training-row filter)."""
    u = units("vehicle_avg_efficiency_last30", 4)
    fleet = hist.agg(mean_of(F.sum(u.cast(WIDE)), F.count(u), 4)).scalar()
    return hist.withColumn("vehicle_efficiency_vs_fleet",
                           F.round(F.col("vehicle_avg_efficiency_last30") - fleet, 4))


def training_rows() -> Column:
    """Rows with enough history to train on: 5+ prior vehicle trips, complete vehicle
    history columns, 1+ prior trip on the route."""
    return ((F.col("vehicle_trip_count_last30") >= MIN_VEHICLE_TRIPS)
            & F.col("vehicle_avg_efficiency_last30").isNotNull()
            & F.col("vehicle_avg_energy_last30").isNotNull()
            & F.col("vehicle_stddev_energy_last30").isNotNull()
            & (F.col("route_trip_count") >= MIN_ROUTE_TRIPS))


def build_features(trips: DataFrame, now: Column | None = None, chunks: int | None = None,
                   skew_safe: bool = True, trips_written: bool = False) -> DataFrame:
    """The ML feature table: 53 columns, trips with enough history only.

    ``trips_written``: ``trips`` is already a scan of a written table; otherwise
    it is written once first, so that measuring and windowing read files."""
    if not trips_written:
        trips = materialize(trips, "feature-trips")
    return features_from_history(materialize(history_stage(trips, chunks, skew_safe), "history"), now)


def features_from_history(hist: DataFrame, now: Column | None = None) -> DataFrame:
    """The feature table from a written ``history_stage`` of all trips (no window, no
    shuffle: the fleet mean is one aggregate, the rest one pass)."""
    out = with_fleet_comparison(hist).withColumns({
        "target_energy_consumption": F.col("total_energy_consumption"),
        "feature_timestamp": now if now is not None else F.current_timestamp(),
    })
    return out.select(*FEATURE_COLUMNS).filter(training_rows())
