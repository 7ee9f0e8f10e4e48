"""Column names and types at every layer.

Raw telemetry keeps the header names of the source CSV files.  They are
renamed once, at the read boundary, to the canonical names below; the trip
keys ``DayNum``, ``VehId`` and ``Trip`` keep their names through every layer
because downstream tables are keyed on them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: raw telemetry header names (they must equal the source
# --- files' headers) and the canonical name each one is renamed to.
RAW_TO_CANONICAL = {
    "DayNum": "DayNum",
    "VehId": "VehId",
    "Trip": "Trip",
    "Timestamp(ms)": "ts_ms",
    "Latitude[deg]": "lat",
    "Longitude[deg]": "lon",
    "Vehicle Speed[km/h]": "speed_kmh",
    "Energy_Consumption": "energy",
    "Fuel Rate[L/hr]": "fuel_rate_lph",
    "MAF[g/sec]": "maf_gps",
    "Engine RPM[RPM]": "engine_rpm",
    "HV Battery SOC[%]": "battery_soc_pct",
    "HV Battery Current[A]": "battery_current_a",
    "HV Battery Voltage[V]": "battery_voltage_v",
    "Elevation Smoothed[m]": "elevation_m",
}

RAW_COLUMNS = list(RAW_TO_CANONICAL)

# Types of the canonical (clean) sample table.
SAMPLE_TYPES = {
    "DayNum": T.DoubleType(),
    "VehId": T.LongType(),
    "Trip": T.LongType(),
    "ts_ms": T.LongType(),
    "lat": T.DoubleType(),
    "lon": T.DoubleType(),
    "speed_kmh": T.DoubleType(),
    "energy": T.DoubleType(),
    "fuel_rate_lph": T.DoubleType(),
    "maf_gps": T.DoubleType(),
    "engine_rpm": T.DoubleType(),
    "battery_soc_pct": T.DoubleType(),
    "battery_current_a": T.DoubleType(),
    "battery_voltage_v": T.DoubleType(),
    "elevation_m": T.DoubleType(),
}

SAMPLE_COLUMNS = list(SAMPLE_TYPES)

COMBUSTION_SIGNALS = ["fuel_rate_lph", "maf_gps", "engine_rpm"]
BATTERY_SIGNALS = ["battery_soc_pct", "battery_current_a", "battery_voltage_v"]

# --- Fixed values: key columns, the vehicle label, and the output column names
# --- and order of every table (the tables' public interface).
TRIP_KEYS = ["DayNum", "VehId", "Trip"]
ROUTE_KEYS = ["origin_lat_rounded", "origin_lon_rounded", "dest_lat_rounded", "dest_lon_rounded"]

BEV_LABEL = "Battery Electric (BEV)"

SILVER_COLUMNS = [
    "DayNum", "VehId", "Trip",
    "trip_date", "trip_start_datetime", "trip_end_datetime",
    "start_timestamp_ms", "end_timestamp_ms",
    "trip_year", "trip_month", "trip_dayofweek", "trip_hour",
    "distance_km", "duration_seconds", "duration_minutes",
    "total_energy_consumption", "efficiency_km_per_energy",
    "origin_lat", "origin_lon", "destination_lat", "destination_lon",
    "avg_speed_kmh", "max_speed_kmh",
    "avg_battery_soc", "min_battery_soc", "max_battery_soc",
    "avg_battery_voltage",
    "avg_elevation_m", "max_elevation_m", "min_elevation_m",
    "elevation_gain_m",
    "trip_count",
    "processing_timestamp",
]

DAILY_COLUMNS = [
    "VehId", "trip_date",
    "total_trips", "total_distance_km", "total_energy_consumption",
    "total_duration_minutes", "avg_efficiency", "avg_speed_kmh", "avg_battery_soc",
    "max_trip_distance_km", "min_trip_distance_km", "stddev_distance_km",
    "max_speed_observed", "avg_elevation_gain_m", "processing_timestamp",
]

ROUTE_COLUMNS = ROUTE_KEYS + [
    "trip_count", "avg_distance_km", "avg_energy_consumption", "avg_duration_minutes",
    "avg_efficiency", "avg_speed_kmh", "avg_elevation_gain_m", "stddev_energy",
    "unique_vehicles", "processing_timestamp",
]

TEMPORAL_COLUMNS = [
    "trip_dayofweek", "trip_hour",
    "trip_count", "avg_distance_km", "avg_energy_consumption", "avg_speed_kmh",
    "avg_efficiency", "stddev_energy", "processing_timestamp",
]

VEHICLE_HISTORY_COLUMNS = [
    "vehicle_avg_efficiency_last30", "vehicle_avg_energy_last30",
    "vehicle_stddev_energy_last30", "vehicle_avg_distance_last30",
    "vehicle_trip_count_last30",
]

ROUTE_HISTORY_COLUMNS = [
    "route_avg_energy_last10", "route_avg_duration_last10",
    "route_avg_speed_last10", "route_trip_count",
]

INTERACTION_COLUMNS = [
    "distance_elevation_interaction", "speed_squared", "speed_per_distance",
    "duration_per_distance", "speed_variability",
]
RATIO_COLUMNS = ["elevation_gradient", "actual_speed_efficiency", "speed_efficiency_ratio"]
BATTERY_COLUMNS = ["battery_soc_range", "battery_usage_rate", "energy_per_km"]
COMPLEXITY_COLUMNS = ["elevation_per_minute", "trip_complexity_score"]
TIME_COLUMNS = ["is_rush_hour", "is_weekend", "hour_sin", "hour_cos"]
CATEGORY_COLUMNS = ["distance_category", "speed_category"]

FEATURE_COLUMNS = (
    ["DayNum", "VehId", "Trip", "trip_date", "start_timestamp_ms",
     "target_energy_consumption",
     "distance_km", "duration_minutes", "avg_speed_kmh", "max_speed_kmh",
     "avg_battery_soc", "min_battery_soc", "max_battery_soc",
     "avg_elevation_m", "elevation_gain_m"]
    + ROUTE_KEYS
    + ["trip_year", "trip_month", "trip_dayofweek", "trip_hour"]
    + VEHICLE_HISTORY_COLUMNS
    + ROUTE_HISTORY_COLUMNS
    + INTERACTION_COLUMNS + RATIO_COLUMNS + BATTERY_COLUMNS + COMPLEXITY_COLUMNS
    + TIME_COLUMNS + CATEGORY_COLUMNS
    + ["vehicle_efficiency_vs_fleet", "feature_timestamp"]
)

# Features only known once the trip is over (they describe the trip itself or
# are derived from the target).  Kept in the table; listed for model builders.
POST_TRIP_COLUMNS = [
    "duration_minutes", "battery_soc_range", "battery_usage_rate", "energy_per_km",
    "elevation_per_minute", "actual_speed_efficiency", "max_battery_soc", "min_battery_soc",
    "avg_battery_soc", "avg_speed_kmh", "max_speed_kmh", "speed_squared", "speed_per_distance",
    "duration_per_distance", "speed_variability", "speed_efficiency_ratio", "trip_complexity_score",
]
