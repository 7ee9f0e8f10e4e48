"""Samples -> one row per trip ``(DayNum, VehId, Trip)`` (the silver table).

Plan shape, chosen for large inputs:

* the vehicle-class list is a separate narrow aggregate (key + six signal
  columns, combined map-side);
* it is written once and counted; if it fits the broadcast budget the samples
  are semi-joined against it map-side, *before* the trip shuffle, so samples
  of other vehicles never cross the network;
* otherwise the trip aggregate runs first (one partial row per trip and task
  is shuffled) and the much smaller trip rows are joined to the list with a
  shuffle join (adaptive execution splits a skewed vehicle);
* every aggregate is algebraic with fixed-width buffers (min/max/sum/count/
  avg, min_by/max_by on a numeric key), so Spark plans hash aggregation and a
  trip with a third of all samples is still pre-aggregated in every task.

Why two narrow scans rather than one wide one (aggregating every vehicle's
trips with signal flags, then classifying from trip rows): battery-electric
vehicles are usually a small share of a mixed fleet, so filtering samples
before the aggregate saves more work than the second, column-pruned scan of
the key and signal columns costs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetframe.functions.calendar import clock_text, daynum_date, daynum_hour, daynum_minute
from fleetframe.functions.geo import haversine_km
from fleetframe.functions.numeric import safe_ratio
from fleetframe.operators.joins import sized_for_broadcast
from fleetframe.operators.quality import SILVER_RULES, expect_or_drop
from fleetframe.operators.vehicles import ev_vehicles
from fleetframe.schema import SILVER_COLUMNS, TRIP_KEYS

# Bytes per row of the broadcast vehicle list (one long key plus row overhead).
_VEHICLE_ROW_BYTES = 32
# Range of the position hash that orders fixes taken in the same millisecond, and of
# the times that fit beside it in a long (to the year 2248 as epoch milliseconds).
_TIE_RANGE = 1 << 20
_TIME_RANGE = 1 << 43


def fix_order() -> Column:
    """Order of GPS fixes within a trip: time, then a hash of the position.

    A primitive 64-bit key keeps the trip aggregate a hash aggregate (a
    min/max over a struct would force a sort of every sample).  The four
    ``min_by``/``max_by`` aggregates compare the same key over the same rows,
    so latitude and longitude always come from one sample; samples at the same
    millisecond are ordered by the position hash, the same way on every run.
    NULL time -> NULL key -> never picked; a time outside +-2^43 ms is an error.
    """
    ts = F.col("ts_ms").cast("long")
    tie = F.pmod(F.xxhash64("lat", "lon"), F.lit(_TIE_RANGE))
    beyond = F.raise_error(F.concat(F.lit("ts_ms out of range: "), ts.cast("string"))).cast("long")
    return F.when((ts < _TIME_RANGE) & (ts > -_TIME_RANGE), ts * F.lit(_TIE_RANGE) + tie).when(ts.isNotNull(), beyond)


def trip_aggregates(samples: DataFrame) -> DataFrame:
    """Per-trip raw aggregates of canonical samples (nothing rounded yet)."""
    ts = F.col("ts_ms")
    order = fix_order()
    return (samples.groupBy(*TRIP_KEYS).agg(
        F.min(ts).alias("start_timestamp_ms"),
        F.max(ts).alias("end_timestamp_ms"),
        F.min_by("lat", order).alias("origin_lat"),
        F.min_by("lon", order).alias("origin_lon"),
        F.max_by("lat", order).alias("destination_lat"),
        F.max_by("lon", order).alias("destination_lon"),
        F.sum("energy").alias("total_energy_consumption"),
        F.avg("battery_soc_pct").alias("avg_battery_soc"),
        F.min("battery_soc_pct").alias("min_battery_soc"),
        F.max("battery_soc_pct").alias("max_battery_soc"),
        F.avg("battery_voltage_v").alias("avg_battery_voltage"),
        F.avg("speed_kmh").alias("avg_speed_kmh"),
        F.max("speed_kmh").alias("max_speed_kmh"),
        F.avg("elevation_m").alias("avg_elevation_m"),
        F.max("elevation_m").alias("max_elevation_m"),
        F.min("elevation_m").alias("min_elevation_m"),
        F.count(F.lit(1)).alias("trip_count"),
    ).select(
        *TRIP_KEYS, "start_timestamp_ms", "end_timestamp_ms",
        "origin_lat", "origin_lon", "destination_lat", "destination_lon",
        "total_energy_consumption", "avg_battery_soc", "min_battery_soc", "max_battery_soc",
        "avg_battery_voltage", "avg_speed_kmh", "max_speed_kmh",
        "avg_elevation_m", "max_elevation_m", "min_elevation_m", "trip_count",
    ))


def trip_measures(agg: DataFrame, now: Column | None = None) -> DataFrame:
    """Derived trip columns in the silver order (no rows dropped).

    Two projections: the clock parts (date, hour, minute, duration, end second)
    first, each computed once; then the columns built from them."""
    c = F.col
    parts = agg.withColumns({
        "_duration": (c("end_timestamp_ms") - c("start_timestamp_ms")) / 1000,
        "_date": daynum_date("DayNum"),
        "_hour": daynum_hour("DayNum"),
        "_minute": daynum_minute("DayNum"),
    }).withColumn("_end_second", c("_hour") * 3600 + c("_minute") * 60 + F.floor(c("_duration")))
    distance = haversine_km("origin_lat", "origin_lon", "destination_lat", "destination_lon")
    derived = {
        "trip_date": c("_date"),
        "trip_start_datetime": clock_text(c("_date"), c("_hour") * 3600 + c("_minute") * 60),
        "trip_end_datetime": clock_text(c("_date"), c("_end_second")),
        "trip_year": F.year("_date"),
        "trip_month": F.month("_date"),
        "trip_dayofweek": F.dayofweek("_date"),
        "trip_hour": c("_hour"),
        "distance_km": distance,
        "duration_seconds": c("_duration"),
        "duration_minutes": F.round(c("_duration") / 60, 2),
        # rounded distance over unrounded energy; zero energy -> NULL
        "efficiency_km_per_energy": F.round(safe_ratio(distance, c("total_energy_consumption")), 4),
        "total_energy_consumption": F.round("total_energy_consumption", 2),
        "avg_battery_soc": F.round("avg_battery_soc", 2),
        "avg_battery_voltage": F.round("avg_battery_voltage", 2),
        "avg_speed_kmh": F.round("avg_speed_kmh", 2),
        "max_speed_kmh": F.round("max_speed_kmh", 2),
        "avg_elevation_m": F.round("avg_elevation_m", 2),
        "elevation_gain_m": F.round(c("max_elevation_m") - c("min_elevation_m"), 2),
        "processing_timestamp": now if now is not None else F.current_timestamp(),
    }
    return parts.select(*[derived[name].alias(name) if name in derived else c(name)
                          for name in SILVER_COLUMNS])


def ev_trip_aggregates(samples: DataFrame, vehicles: DataFrame | None = None,
                       vehicles_written: bool = False) -> DataFrame:
    """Trip aggregates of battery-electric vehicles only (see module doc).

    ``vehicles_written``: ``vehicles`` is a scan of an already written table."""
    if vehicles is None:
        vehicles, vehicles_written = ev_vehicles(samples), False
    keys, fits = sized_for_broadcast(vehicles.select("VehId"), _VEHICLE_ROW_BYTES, "ev-vehicles",
                                     written=vehicles_written)
    if fits:
        kept = samples.join(F.broadcast(keys), "VehId", "left_semi")
        return trip_aggregates(kept)
    # keys are unique per VehId, so the inner join is the semi-join; an inner
    # join also stays above the aggregate (a semi-join would be pushed below it).
    # Spark makes a Bloom filter at run time from a join side that has a comparison (this one
    # holds for every id) and puts it on the samples' scan: few samples of other vehicles
    # reach the trip shuffle, whatever the length of the list.
    listed = keys.filter(F.col("VehId") >= F.lit(-(1 << 63)))
    return trip_aggregates(samples).join(listed, "VehId", "inner")


def build_trips(samples: DataFrame, vehicles: DataFrame | None = None, rules=SILVER_RULES,
                now: Column | None = None) -> DataFrame:
    """The silver trip table: EV trips, derived measures, quality rules applied."""
    return expect_or_drop(trip_measures(ev_trip_aggregates(samples, vehicles), now), rules)
