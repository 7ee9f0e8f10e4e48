"""Independent DuckDB SQL for every registered query.

Written from the documented semantics, not generated from the Spark code.
Tables ``events`` and ``orders`` are the driver's pre-registered views.

Parity rules (Spark vs DuckDB):
* rounding: Spark rounds HALF_UP on the decimal text of the double, so the
  oracle rounds ``CAST(CAST(x AS VARCHAR) AS DECIMAL(38,20))``;
* milliseconds: ``epoch_us(ts) // 1000`` (``epoch_ms`` rounds);
* ``dayofweek``: DuckDB counts Sunday = 0, Spark 1;
* integer results are cast to the Spark type (INTEGER / BIGINT).
"""

from __future__ import annotations

import math


def rnd(expr: str, n: int) -> str:
    """Spark-compatible HALF_UP rounding of a DOUBLE expression."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,20)), {n}) AS DOUBLE)"


def div(num: str, den: str) -> str:
    """num / den, NULL for a zero or NULL denominator."""
    return f"(CASE WHEN ({den}) = 0 THEN NULL ELSE ({num}) / ({den}) END)"


def guarded(num: str, den: str, n: int) -> str:
    """round(num/den) when den > 0 else 0."""
    return rnd(f"CASE WHEN ({den}) > 0 THEN ({num}) / ({den}) ELSE 0 END", n)


def clean(expr: str) -> str:
    v = f"TRY_CAST(trim(CAST({expr} AS VARCHAR)) AS DOUBLE)"
    return f"(CASE WHEN isnan({v}) THEN NULL ELSE {v} END)"


HOUR_ANGLE = repr(2 * math.pi / 24)


# Exact arithmetic on fixed-scale values: integer units, exact sums, HALF_UP
# rounding in integers.  ``over`` is an optional window clause (" OVER w").
def _u(x: str, s: int) -> str:
    return f"CAST(round(({x}) * {10 ** s}) AS BIGINT)"


def x_sum(x: str, s: int, over: str = "") -> str:
    return f"(CAST(sum({_u(x, s)}){over} AS DOUBLE) / CAST({10 ** s} AS DOUBLE))"


def x_mean(x: str, s: int, over: str = "") -> str:
    n = f"count({_u(x, s)}){over}"
    return (f"(CASE WHEN {n} > 0 THEN CAST(sum({_u(x, s)}){over} AS DOUBLE)"
            f" / CAST({n} * {10 ** s} AS DOUBLE) END)")


def x_rmean(x: str, s: int, k: int, over: str = "") -> str:
    S, n = f"sum({_u(x, s)}){over}", f"count({_u(x, s)}){over}"
    d = f"({n} * {10 ** s})"
    q = f"((abs({S}) * {2 * 10 ** k} + {d}) // (2 * {d}))"
    return (f"(CASE WHEN {n} > 0 THEN CAST(CASE WHEN {S} < 0 THEN -{q} ELSE {q} END AS DOUBLE)"
            f" / CAST({10 ** k} AS DOUBLE) END)")


def x_sd(x: str, s: int, over: str = "") -> str:
    U = _u(x, s)
    S, n, Q = f"sum({U}){over}", f"count({U}){over}", f"sum(CAST({U} AS HUGEINT) * {U}){over}"
    return (f"(CASE WHEN {n} > 1 THEN sqrt(CAST({n} * {Q} - {S} * {S} AS DOUBLE)"
            f" / (CAST({n} AS DOUBLE) * CAST({n} - 1 AS DOUBLE))) / CAST({10 ** s} AS DOUBLE) END)")

# ---------------------------------------------------------------------------
# Base chain: events -> raw telemetry -> clean samples -> vehicles -> trips.
# ---------------------------------------------------------------------------

CTE_TELEMETRY = """
ev_days AS (
  SELECT *, datediff('day', DATE '2023-12-31', CAST(ts AS DATE)) AS d FROM events
),
telemetry AS (
  SELECT
    CAST(d AS DOUBLE) + ((user_id * 7 + d * 5) % 64) / 64 AS "DayNum",
    user_id AS "VehId",
    CAST(d AS BIGINT) AS "Trip",
    CAST((epoch_us(ts) // 1000) % 86400000 AS BIGINT) AS "Timestamp(ms)",
    CAST(42.22 AS DOUBLE) + (event_id % 4) * CAST(0.01 AS DOUBLE) + (event_id % 5) * CAST(0.001 AS DOUBLE) AS "Latitude[deg]",
    CAST(-83.75 AS DOUBLE) + (event_id % 3) * CAST(0.01 AS DOUBLE) AS "Longitude[deg]",
    CAST((event_id * 13) % 121 AS DOUBLE) AS "Vehicle Speed[km/h]",
    CASE WHEN event_type = 'error' THEN 'NaN' WHEN user_id % 10 = 4 THEN '0.0'
         ELSE CAST(value AS VARCHAR) END AS "Energy_Consumption",
    CASE WHEN user_id % 5 = 0 THEN '1.5' ELSE 'NaN' END AS "Fuel Rate[L/hr]",
    CASE WHEN user_id % 5 = 0 AND event_id % 2 = 0 THEN '12.0' ELSE 'NaN' END AS "MAF[g/sec]",
    CASE WHEN user_id % 5 = 0 THEN '1800' ELSE 'NaN' END AS "Engine RPM[RPM]",
    CASE WHEN user_id % 5 = 1 OR event_id % 11 = 0 THEN 'NaN'
         ELSE CAST(CAST(20.0 AS DOUBLE) + (event_id % 320) * CAST(0.25 AS DOUBLE) AS VARCHAR) END AS "HV Battery SOC[%]",
    CASE WHEN user_id % 5 = 1 THEN 'NaN'
         ELSE CAST((event_id % 40) * CAST(-0.25 AS DOUBLE) AS VARCHAR) END AS "HV Battery Current[A]",
    CASE WHEN user_id % 5 = 1 THEN 'NaN'
         ELSE CAST(CAST(350.0 AS DOUBLE) + (event_id % 50) * CAST(0.5 AS DOUBLE) AS VARCHAR) END AS "HV Battery Voltage[V]",
    CAST(200.0 AS DOUBLE) + event_id % 37 AS "Elevation Smoothed[m]"
  FROM ev_days
)"""

CTE_SAMPLES = f"""
samples AS (
  SELECT
    "DayNum", "VehId", "Trip", "Timestamp(ms)" AS ts_ms,
    "Latitude[deg]" AS lat, "Longitude[deg]" AS lon, "Vehicle Speed[km/h]" AS speed_kmh,
    {clean('"Energy_Consumption"')} AS energy,
    {clean('"Fuel Rate[L/hr]"')} AS fuel_rate_lph,
    {clean('"MAF[g/sec]"')} AS maf_gps,
    {clean('"Engine RPM[RPM]"')} AS engine_rpm,
    {clean('"HV Battery SOC[%]"')} AS battery_soc_pct,
    {clean('"HV Battery Current[A]"')} AS battery_current_a,
    {clean('"HV Battery Voltage[V]"')} AS battery_voltage_v,
    "Elevation Smoothed[m]" AS elevation_m
  FROM telemetry
)"""

CTE_VEHICLES = """
vehicle_signals AS (
  SELECT "VehId",
    CAST(max(CASE WHEN fuel_rate_lph IS NOT NULL OR maf_gps IS NOT NULL OR engine_rpm IS NOT NULL
                  THEN 1 ELSE 0 END) AS INTEGER) AS has_combustion,
    CAST(max(CASE WHEN battery_soc_pct IS NOT NULL OR battery_current_a IS NOT NULL
                       OR battery_voltage_v IS NOT NULL THEN 1 ELSE 0 END) AS INTEGER) AS has_battery
  FROM samples GROUP BY "VehId"
),
ev_vehicles AS (
  SELECT "VehId", 'Battery Electric (BEV)' AS vehicle_type
  FROM vehicle_signals WHERE has_battery = 1 AND has_combustion = 0
)"""

CTE_TRIP_AGG = """
trip_agg AS (
  SELECT "DayNum", "VehId", "Trip",
    min(ts_ms) AS start_timestamp_ms, max(ts_ms) AS end_timestamp_ms,
    arg_min(lat, ts_ms) AS origin_lat, arg_min(lon, ts_ms) AS origin_lon,
    arg_max(lat, ts_ms) AS destination_lat, arg_max(lon, ts_ms) AS destination_lon,
    sum(energy) AS energy_sum,
    avg(battery_soc_pct) AS soc_avg, min(battery_soc_pct) AS min_battery_soc,
    max(battery_soc_pct) AS max_battery_soc, avg(battery_voltage_v) AS volt_avg,
    avg(speed_kmh) AS speed_avg, max(speed_kmh) AS speed_max,
    avg(elevation_m) AS elev_avg, max(elevation_m) AS max_elevation_m,
    min(elevation_m) AS min_elevation_m, count(*) AS trip_count
  FROM samples
  WHERE "VehId" IN (SELECT "VehId" FROM ev_vehicles)
  GROUP BY "DayNum", "VehId", "Trip"
)"""

_A = ("sin(radians(destination_lat - origin_lat) / 2) * sin(radians(destination_lat - origin_lat) / 2)"
      " + cos(radians(origin_lat)) * cos(radians(destination_lat))"
      " * sin(radians(destination_lon - origin_lon) / 2) * sin(radians(destination_lon - origin_lon) / 2)")

CTE_TRIPS_ALL = f"""
trip_base AS (
  SELECT *,
    (end_timestamp_ms - start_timestamp_ms) / 1000 AS duration_seconds,
    CASE WHEN ({_A}) > 1 THEN CAST(1.0 AS DOUBLE) ELSE ({_A}) END AS hav_a,
    DATE '2017-10-31' + CAST(floor("DayNum") AS INTEGER) AS trip_date,
    CAST(floor(("DayNum" - floor("DayNum")) * 24) AS INTEGER) AS trip_hour,
    CAST(floor((("DayNum" - floor("DayNum")) * 24 - floor(("DayNum" - floor("DayNum")) * 24)) * 60) AS INTEGER) AS trip_minute
  FROM trip_agg
),
trip_base2 AS (
  SELECT *,
    {rnd('6371.0 * 2 * atan2(sqrt(hav_a), sqrt(1 - hav_a))', 2)} AS distance_km,
    CAST(trip_hour * 3600 + trip_minute * 60 + floor(duration_seconds) AS BIGINT) AS end_secs
  FROM trip_base
),
trips_all AS (
  SELECT "DayNum", "VehId", "Trip", trip_date,
    CAST(trip_date AS VARCHAR) || ' ' || lpad(CAST(trip_hour AS VARCHAR), 2, '0') || ':'
      || lpad(CAST(trip_minute AS VARCHAR), 2, '0') || ':00' AS trip_start_datetime,
    CAST(trip_date + CAST(end_secs // 86400 AS INTEGER) AS VARCHAR) || ' '
      || lpad(CAST((end_secs % 86400) // 3600 AS VARCHAR), 2, '0') || ':'
      || lpad(CAST((end_secs % 3600) // 60 AS VARCHAR), 2, '0') || ':'
      || lpad(CAST(end_secs % 60 AS VARCHAR), 2, '0') AS trip_end_datetime,
    start_timestamp_ms, end_timestamp_ms,
    CAST(year(trip_date) AS INTEGER) AS trip_year,
    CAST(month(trip_date) AS INTEGER) AS trip_month,
    CAST(dayofweek(trip_date) + 1 AS INTEGER) AS trip_dayofweek,
    trip_hour, trip_minute,
    distance_km, duration_seconds,
    {rnd('duration_seconds / 60', 2)} AS duration_minutes,
    {rnd('energy_sum', 2)} AS total_energy_consumption,
    {rnd(div('distance_km', 'energy_sum'), 4)} AS efficiency_km_per_energy,
    origin_lat, origin_lon, destination_lat, destination_lon,
    {rnd('speed_avg', 2)} AS avg_speed_kmh,
    {rnd('speed_max', 2)} AS max_speed_kmh,
    {rnd('soc_avg', 2)} AS avg_battery_soc, min_battery_soc, max_battery_soc,
    {rnd('volt_avg', 2)} AS avg_battery_voltage,
    {rnd('elev_avg', 2)} AS avg_elevation_m, max_elevation_m, min_elevation_m,
    {rnd('max_elevation_m - min_elevation_m', 2)} AS elevation_gain_m,
    trip_count
  FROM trip_base2
),
silver AS (
  SELECT * FROM trips_all WHERE trip_count > 0 AND duration_seconds > 0
)"""

BASE = [CTE_TELEMETRY, CTE_SAMPLES, CTE_VEHICLES, CTE_TRIP_AGG, CTE_TRIPS_ALL]

SILVER_COLS = """"DayNum", "VehId", "Trip", trip_date, trip_start_datetime, trip_end_datetime,
  start_timestamp_ms, end_timestamp_ms, trip_year, trip_month, trip_dayofweek, trip_hour,
  distance_km, duration_seconds, duration_minutes, total_energy_consumption,
  efficiency_km_per_energy, origin_lat, origin_lon, destination_lat, destination_lon,
  avg_speed_kmh, max_speed_kmh, avg_battery_soc, min_battery_soc, max_battery_soc,
  avg_battery_voltage, avg_elevation_m, max_elevation_m, min_elevation_m, elevation_gain_m,
  trip_count"""

KEYS = '"DayNum", "VehId", "Trip"'

STRICT = ("trip_count > 0 AND duration_seconds > 0 AND distance_km > 0 AND total_energy_consumption > 0"
          ' AND "VehId" IS NOT NULL AND "Trip" IS NOT NULL AND "DayNum" IS NOT NULL'
          " AND start_timestamp_ms IS NOT NULL")


CTE_FEATURES = f"""
feat_base AS (
  SELECT *, {rnd('origin_lat', 2)} AS origin_lat_rounded, {rnd('origin_lon', 2)} AS origin_lon_rounded,
    {rnd('destination_lat', 2)} AS dest_lat_rounded, {rnd('destination_lon', 2)} AS dest_lon_rounded
  FROM silver
),
feat_hist AS (
  SELECT *,
    {x_rmean('efficiency_km_per_energy', 4, 4, ' OVER wv')} AS vehicle_avg_efficiency_last30,
    {x_rmean('total_energy_consumption', 2, 2, ' OVER wv')} AS vehicle_avg_energy_last30,
    {rnd(x_sd('total_energy_consumption', 2, ' OVER wv'), 2)} AS vehicle_stddev_energy_last30,
    {x_rmean('distance_km', 2, 2, ' OVER wv')} AS vehicle_avg_distance_last30,
    count("Trip") OVER wv AS vehicle_trip_count_last30,
    {x_rmean('total_energy_consumption', 2, 2, ' OVER wr')} AS route_avg_energy_last10,
    {x_rmean('duration_minutes', 2, 2, ' OVER wr')} AS route_avg_duration_last10,
    {x_rmean('avg_speed_kmh', 2, 2, ' OVER wr')} AS route_avg_speed_last10,
    count("Trip") OVER wr AS route_trip_count
  FROM feat_base
  WINDOW wv AS (PARTITION BY "VehId" ORDER BY "DayNum", "Trip"
                ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING),
         wr AS (PARTITION BY origin_lat_rounded, origin_lon_rounded, dest_lat_rounded, dest_lon_rounded
                ORDER BY "DayNum", "VehId", "Trip" ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)
),
feat_eng AS (
  SELECT *,
    {rnd('distance_km * elevation_gain_m', 2)} AS distance_elevation_interaction,
    {rnd('pow(avg_speed_kmh, 2)', 2)} AS speed_squared,
    {guarded('pow(avg_speed_kmh, 2)', 'distance_km', 2)} AS speed_per_distance,
    {guarded('duration_minutes', 'distance_km', 4)} AS duration_per_distance,
    {rnd('max_speed_kmh - avg_speed_kmh', 2)} AS speed_variability,
    {guarded('elevation_gain_m', 'distance_km', 4)} AS elevation_gradient,
    {guarded('distance_km * 60', 'duration_minutes', 2)} AS actual_speed_efficiency,
    {guarded('avg_speed_kmh', 'max_speed_kmh', 4)} AS speed_efficiency_ratio,
    {rnd('max_battery_soc - min_battery_soc', 2)} AS battery_soc_range,
    {guarded('max_battery_soc - min_battery_soc', 'duration_minutes', 4)} AS battery_usage_rate,
    {guarded('total_energy_consumption', 'distance_km', 4)} AS energy_per_km,
    {guarded('elevation_gain_m', 'duration_minutes', 4)} AS elevation_per_minute,
    CAST(CASE WHEN trip_hour BETWEEN 7 AND 9 OR trip_hour BETWEEN 17 AND 19 THEN 1 ELSE 0 END AS INTEGER) AS is_rush_hour,
    CAST(CASE WHEN trip_dayofweek IN (1, 7) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
    {rnd(f'sin(trip_hour * CAST({HOUR_ANGLE} AS DOUBLE))', 4)} AS hour_sin,
    {rnd(f'cos(trip_hour * CAST({HOUR_ANGLE} AS DOUBLE))', 4)} AS hour_cos,
    CAST(CASE WHEN distance_km <= 5 THEN 0 WHEN distance_km <= 15 THEN 1 WHEN distance_km <= 30 THEN 2
              ELSE 3 END AS DOUBLE) AS distance_category,
    CAST(CASE WHEN avg_speed_kmh <= 30 THEN 0 WHEN avg_speed_kmh <= 60 THEN 1 ELSE 2 END AS DOUBLE) AS speed_category
  FROM feat_hist
),
feat_all AS (
  SELECT *,
    {rnd('speed_variability / CAST(10.0 AS DOUBLE) + elevation_gradient * 100', 2)} AS trip_complexity_score,
    {rnd(f"vehicle_avg_efficiency_last30 - (SELECT {x_mean('vehicle_avg_efficiency_last30', 4)} FROM feat_hist)", 4)}
      AS vehicle_efficiency_vs_fleet
  FROM feat_eng
)"""

FEATURE_SELECT = """"DayNum", "VehId", "Trip", trip_date, start_timestamp_ms,
  total_energy_consumption AS target_energy_consumption,
  distance_km, duration_minutes, avg_speed_kmh, max_speed_kmh,
  avg_battery_soc, min_battery_soc, max_battery_soc, avg_elevation_m, elevation_gain_m,
  origin_lat_rounded, origin_lon_rounded, dest_lat_rounded, dest_lon_rounded,
  trip_year, trip_month, trip_dayofweek, trip_hour,
  vehicle_avg_efficiency_last30, vehicle_avg_energy_last30, vehicle_stddev_energy_last30,
  vehicle_avg_distance_last30, vehicle_trip_count_last30,
  route_avg_energy_last10, route_avg_duration_last10, route_avg_speed_last10, route_trip_count,
  distance_elevation_interaction, speed_squared, speed_per_distance, duration_per_distance,
  speed_variability, elevation_gradient, actual_speed_efficiency, speed_efficiency_ratio,
  battery_soc_range, battery_usage_rate, energy_per_km, elevation_per_minute,
  trip_complexity_score, is_rush_hour, is_weekend, hour_sin, hour_cos,
  distance_category, speed_category, vehicle_efficiency_vs_fleet"""

FEATURE_FILTER = """vehicle_trip_count_last30 >= 5 AND vehicle_avg_efficiency_last30 IS NOT NULL
  AND vehicle_avg_energy_last30 IS NOT NULL AND vehicle_stddev_energy_last30 IS NOT NULL
  AND route_trip_count >= 1"""


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


def _base(body: str) -> str:
    return with_(BASE, body)


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["telemetry_view"] = with_([CTE_TELEMETRY], "SELECT * FROM telemetry")
    q["clean_signals"] = with_([CTE_TELEMETRY, CTE_SAMPLES], "SELECT * FROM samples")
    q["csv_batch_ingest"] = q["clean_signals"]
    q["csv_stream_ingest"] = q["clean_signals"]
    q["csv_float_ids"] = q["clean_signals"]
    q["csv_wide_header"] = q["clean_signals"]
    q["csv_stream_evolution"] = with_([CTE_TELEMETRY, CTE_SAMPLES], """SELECT *,
        CASE WHEN "Trip" % 2 <> 0 THEN CAST("Trip" AS VARCHAR) END AS new_col FROM samples""")
    q["csv_schema_log"] = with_([CTE_TELEMETRY, CTE_SAMPLES], """SELECT *,
        CAST("Trip" AS DOUBLE) + CASE WHEN "Trip" % 2 <> 0 THEN 0.5 ELSE 0 END AS aux,
        CASE WHEN "Trip" % 2 <> 0 THEN 'v' || CAST("Trip" AS VARCHAR) END AS added, 2 AS schema_versions FROM samples""")
    broken = {"VehId": '"Timestamp(ms)" % 97 = 0', "Energy_Consumption": '"Timestamp(ms)" % 89 = 0',
              "Latitude[deg]": '"Trip" % 50 = 7', "_no_key": '"Timestamp(ms)" % 97 = 0'}
    q["csv_rescued_values"] = with_([CTE_TELEMETRY], " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_values FROM telemetry WHERE {cond} HAVING count(*) > 0"
        for c, cond in broken.items()))
    broken = {c: cond.replace('"Timestamp(ms)"', "ts_ms") for c, cond in broken.items() if c != "_no_key"}
    pair = lambda c, text: f"""CASE WHEN {broken[c]} THEN '"{c}":"' || {text} || '"' END"""
    entries = ", ".join([pair("VehId", """CAST("VehId" AS VARCHAR) || '.5'"""), pair("Latitude[deg]", "'42,22'"),
                         pair("Energy_Consumption", "'n/a'")])
    unless = lambda c, column: f"CASE WHEN NOT ({broken[c]}) THEN {column} END"
    q["csv_rescued_samples"] = with_([CTE_TELEMETRY, CTE_SAMPLES], f"""SELECT * REPLACE (
        {unless("VehId", '"VehId"')} AS "VehId", {unless("Latitude[deg]", "lat")} AS lat, {unless("Energy_Consumption", "energy")} AS energy),
        CASE WHEN {" OR ".join(broken.values())} THEN '{{' || concat_ws(',', {entries}) || '}}' END AS "_rescued_data"
        FROM samples""")
    q["ingestion_time"] = with_([CTE_TELEMETRY], """SELECT '2024-01-01 00:00:00' AS ingested_at,
        count(*) AS n_rows FROM telemetry""")
    q["silver_table_round_trip"] = _base(f"""SELECT {SILVER_COLS}, '2024-01-01 00:00:00' AS processed_at,
        'DayNum,VehId,Trip' AS table_keys FROM silver""")
    q["vehicle_classes"] = with_([CTE_TELEMETRY, CTE_SAMPLES, CTE_VEHICLES], "SELECT * FROM vehicle_signals")
    q["ev_vehicles"] = with_([CTE_TELEMETRY, CTE_SAMPLES, CTE_VEHICLES],
                             'SELECT * FROM ev_vehicles ORDER BY "VehId"')
    q["ev_telemetry_semi_join"] = with_(
        [CTE_TELEMETRY, CTE_SAMPLES, CTE_VEHICLES],
        'SELECT * FROM samples WHERE "VehId" IN (SELECT "VehId" FROM ev_vehicles)')
    q["trip_bounds"] = _base(f"""SELECT {KEYS}, start_timestamp_ms, end_timestamp_ms, trip_count,
        duration_seconds, duration_minutes FROM trips_all""")
    q["trip_endpoints"] = _base(f"""SELECT {KEYS}, origin_lat, origin_lon, destination_lat,
        destination_lon FROM trips_all""")
    q["trip_signal_stats"] = _base(f"""SELECT {KEYS}, total_energy_consumption, avg_battery_soc,
        min_battery_soc, max_battery_soc, avg_battery_voltage, avg_speed_kmh, max_speed_kmh,
        avg_elevation_m, max_elevation_m, min_elevation_m FROM trips_all""")
    q["trip_calendar"] = _base(f"""SELECT {KEYS}, trip_date, trip_year, trip_month, trip_dayofweek,
        trip_hour, trip_minute FROM trips_all""")
    q["trip_datetimes"] = _base(f"""SELECT {KEYS}, duration_seconds, trip_start_datetime,
        trip_end_datetime FROM trips_all""")
    q["trip_distance"] = _base(f"SELECT {KEYS}, distance_km, duration_minutes FROM trips_all")
    q["trip_efficiency"] = _base(f"""SELECT {KEYS}, distance_km, total_energy_consumption,
        efficiency_km_per_energy, elevation_gain_m FROM trips_all""")
    q["quality_filtered_trips"] = _base(f"""SELECT {KEYS}, distance_km, total_energy_consumption,
        duration_seconds FROM trips_all WHERE {STRICT}""")
    rules = [
        ("valid_trip", "trip_count > 0"),
        ("valid_duration", "duration_seconds > 0"),
        ("valid_distance", "distance_km > 0"),
        ("valid_energy", "total_energy_consumption > 0"),
        ("critical_not_null", '"VehId" IS NOT NULL AND "Trip" IS NOT NULL AND "DayNum" IS NOT NULL'
                              " AND start_timestamp_ms IS NOT NULL"),
    ]
    q["quality_metrics"] = _base(" UNION ALL ".join(
        f"""SELECT '{name}' AS rule, count(*) AS rows_checked,
            CAST(count_if(coalesce({cond}, false)) AS BIGINT) AS rows_passed,
            count(*) - CAST(count_if(coalesce({cond}, false)) AS BIGINT) AS rows_failed FROM trips_all"""
        for name, cond in rules))
    q["silver_trips"] = _base(f"SELECT {SILVER_COLS} FROM silver")

    q["vehicle_daily_stats"] = _base(f"""SELECT "VehId", trip_date,
        count("Trip") AS total_trips,
        {x_sum('distance_km', 2)} AS total_distance_km,
        {x_sum('total_energy_consumption', 2)} AS total_energy_consumption,
        {rnd(x_sum('duration_minutes', 2), 4)} AS total_duration_minutes,
        {x_rmean('efficiency_km_per_energy', 4, 4)} AS avg_efficiency,
        {x_rmean('avg_speed_kmh', 2, 2)} AS avg_speed_kmh,
        {x_rmean('avg_battery_soc', 2, 2)} AS avg_battery_soc,
        max(distance_km) AS max_trip_distance_km, min(distance_km) AS min_trip_distance_km,
        {rnd(x_sd('distance_km', 2), 4)} AS stddev_distance_km,
        max(max_speed_kmh) AS max_speed_observed,
        {rnd(x_mean('elevation_gain_m', 2), 4)} AS avg_elevation_gain_m
      FROM silver GROUP BY "VehId", trip_date""")
    q["route_patterns"] = _base(f"""SELECT origin_lat_rounded, origin_lon_rounded,
        dest_lat_rounded, dest_lon_rounded,
        count("Trip") AS trip_count,
        {x_rmean('distance_km', 2, 2)} AS avg_distance_km,
        {x_rmean('total_energy_consumption', 2, 2)} AS avg_energy_consumption,
        {rnd(x_mean('duration_minutes', 2), 4)} AS avg_duration_minutes,
        {x_rmean('efficiency_km_per_energy', 4, 4)} AS avg_efficiency,
        {x_rmean('avg_speed_kmh', 2, 2)} AS avg_speed_kmh,
        {rnd(x_mean('elevation_gain_m', 2), 4)} AS avg_elevation_gain_m,
        {rnd(x_sd('total_energy_consumption', 2), 4)} AS stddev_energy,
        count(DISTINCT "VehId") AS unique_vehicles
      FROM (SELECT *, {rnd('origin_lat', 2)} AS origin_lat_rounded,
                      {rnd('origin_lon', 2)} AS origin_lon_rounded,
                      {rnd('destination_lat', 2)} AS dest_lat_rounded,
                      {rnd('destination_lon', 2)} AS dest_lon_rounded FROM silver)
      GROUP BY origin_lat_rounded, origin_lon_rounded, dest_lat_rounded, dest_lon_rounded
      HAVING count("Trip") >= 3""")
    q["temporal_patterns"] = _base(f"""SELECT trip_dayofweek, trip_hour,
        count("Trip") AS trip_count,
        {x_rmean('distance_km', 2, 2)} AS avg_distance_km,
        {x_rmean('total_energy_consumption', 2, 2)} AS avg_energy_consumption,
        {rnd(x_mean('avg_speed_kmh', 2), 4)} AS avg_speed_kmh,
        {x_rmean('efficiency_km_per_energy', 4, 4)} AS avg_efficiency,
        {rnd(x_sd('total_energy_consumption', 2), 4)} AS stddev_energy
      FROM silver GROUP BY trip_dayofweek, trip_hour""")

    def feat(body: str) -> str:
        return with_(BASE + [CTE_FEATURES], body)

    q["vehicle_history_30"] = feat(f"""SELECT {KEYS}, vehicle_avg_efficiency_last30,
        vehicle_avg_energy_last30, vehicle_stddev_energy_last30, vehicle_avg_distance_last30,
        vehicle_trip_count_last30 FROM feat_hist""")
    q["route_history_10"] = feat(f"""SELECT {KEYS}, origin_lat_rounded, origin_lon_rounded,
        dest_lat_rounded, dest_lon_rounded, route_avg_energy_last10, route_avg_duration_last10,
        route_avg_speed_last10, route_trip_count FROM feat_hist""")
    q["fleet_comparison"] = feat(f"""SELECT {KEYS}, vehicle_avg_efficiency_last30,
        vehicle_efficiency_vs_fleet FROM feat_all""")
    q["interaction_features"] = feat(f"""SELECT {KEYS}, distance_elevation_interaction,
        speed_squared, speed_per_distance, duration_per_distance, speed_variability FROM feat_all""")
    q["ratio_features"] = feat(f"""SELECT {KEYS}, elevation_gradient, actual_speed_efficiency,
        speed_efficiency_ratio FROM feat_all""")
    q["battery_features"] = feat(f"""SELECT {KEYS}, battery_soc_range, battery_usage_rate,
        energy_per_km FROM feat_all""")
    q["complexity_features"] = feat(f"""SELECT {KEYS}, elevation_per_minute,
        trip_complexity_score FROM feat_all""")
    q["time_features"] = feat(f"""SELECT {KEYS}, trip_hour, trip_dayofweek, is_rush_hour,
        is_weekend, hour_sin, hour_cos FROM feat_all""")
    q["category_features"] = feat(f"""SELECT {KEYS}, distance_km, avg_speed_kmh,
        distance_category, speed_category FROM feat_all""")
    q["vehicle_distance_class"] = _base(f"""SELECT "VehId", trip_dayofweek, total_distance_km,
        CAST(CASE WHEN total_distance_km <= 5 THEN 0 WHEN total_distance_km <= 15 THEN 1
                  WHEN total_distance_km <= 30 THEN 2 ELSE 3 END AS DOUBLE) AS distance_category
      FROM (SELECT "VehId", trip_dayofweek, {x_sum('distance_km', 2)} AS total_distance_km
            FROM silver GROUP BY ROLLUP ("VehId", trip_dayofweek))""")
    q["feature_table"] = feat(f"SELECT {FEATURE_SELECT} FROM feat_all WHERE {FEATURE_FILTER}")
    q["key_check"] = feat(f"""SELECT
        CAST(coalesce(sum(n), 0) AS BIGINT) AS rows,
        CAST(coalesce(sum(CASE WHEN "VehId" IS NULL THEN n END), 0) AS BIGINT) AS null_vehid,
        CAST(coalesce(sum(CASE WHEN "Trip" IS NULL THEN n END), 0) AS BIGINT) AS null_trip,
        CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_keys
      FROM (SELECT {KEYS}, count(*) AS n FROM feat_all WHERE {FEATURE_FILTER} GROUP BY {KEYS})""")
    q["table_row_counts"] = feat(f"""
      SELECT 'silver_ev_trips' AS table_name, count(*) AS row_count FROM silver
      UNION ALL SELECT 'gold_vehicle_daily_stats', count(*)
        FROM (SELECT 1 FROM silver GROUP BY "VehId", trip_date)
      UNION ALL SELECT 'gold_route_patterns', count(*)
        FROM (SELECT 1 FROM feat_base GROUP BY origin_lat_rounded, origin_lon_rounded,
              dest_lat_rounded, dest_lon_rounded HAVING count("Trip") >= 3)
      UNION ALL SELECT 'gold_temporal_patterns', count(*)
        FROM (SELECT 1 FROM silver GROUP BY trip_dayofweek, trip_hour)
      UNION ALL SELECT 'ml_features_energy_prediction', count(*) FROM feat_all WHERE {FEATURE_FILTER}""")
    q["silver_preview"] = _base(f"""SELECT {SILVER_COLS} FROM silver
      ORDER BY "VehId", "DayNum", "Trip" LIMIT 10""")
    q["priority_order_history"] = f"""SELECT o_orderkey, o_orderpriority, o_orderdate,
        count(o_orderkey) OVER w AS prev_order_count,
        {x_rmean('o_totalprice', 2, 2, ' OVER w')} AS prev_avg_totalprice,
        {rnd(x_sd('o_totalprice', 2, ' OVER w'), 2)} AS prev_stddev_totalprice
      FROM orders
      WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey
                   ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)"""
    q["priority_order_history_split"] = q["priority_order_history"]
    return q
