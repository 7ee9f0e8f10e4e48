"""Gold summaries of the trip table: per vehicle-day, per route, per hour of week.

Each is one ``groupBy().agg()``: Catalyst plans a partial aggregate per task
and one shuffle of partial rows, so a hot key costs one partial row per task.
Means, sums and deviations of the (already rounded) trip measures are exact
(``functions.exact``): the same result for every partitioning of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetframe.functions.exact import (
    SQUARE_PARTS, mean_of, out_of_range, rounded_mean_of, sum_of, unit_aggs, with_stddev,
)
from fleetframe.functions.geo import route_key_columns
from fleetframe.schema import DAILY_COLUMNS, ROUTE_COLUMNS, ROUTE_KEYS, TEMPORAL_COLUMNS

# Fixed value: a route is reported once it has this many trips.
MIN_ROUTE_TRIPS = 3


def _now(now: Column | None) -> Column:
    return now if now is not None else F.current_timestamp()


class _Exact:
    """Named unit aggregates for one measure inside a groupBy().agg()."""

    def __init__(self, column: str, scale: int, squares: bool = False):
        self.column, self.scale, self.squares = column, scale, squares
        self.tag = f"_x_{column}"

    def aggs(self) -> list[Column]:
        parts = unit_aggs(self.column, self.scale, squares=self.squares)
        return [expr.alias(f"{self.tag}_{k}") for k, expr in parts.items()]

    def _p(self, k: str) -> Column:
        return F.col(f"{self.tag}_{k}")

    def total(self) -> Column:
        return sum_of(self._p("s"), self.scale)

    def mean(self) -> Column:
        return mean_of(self._p("s"), self._p("n"), self.scale)

    def rounded_mean(self, digits: int) -> Column:
        return rounded_mean_of(self._p("s"), self._p("n"), self.scale, digits)

    def with_stddev(self, agg: DataFrame, name: str) -> DataFrame:
        return with_stddev(agg, name, self._p("s"), self._p("q"), self._p("n"), self.scale)


def _exact_aggs(*measures: _Exact) -> list[Column]:
    return [a for m in measures for a in m.aggs()]


def vehicle_daily_stats(trips: DataFrame, now: Column | None = None) -> DataFrame:
    """Per vehicle and trip date: trip count, exact totals and means, extremes and
    the sample deviation of trip distance."""
    dist = _Exact("distance_km", 2, squares=True)
    energy = _Exact("total_energy_consumption", 2)
    dur = _Exact("duration_minutes", 2)
    eff = _Exact("efficiency_km_per_energy", 4)
    speed = _Exact("avg_speed_kmh", 2)
    soc = _Exact("avg_battery_soc", 2)
    gain = _Exact("elevation_gain_m", 2)
    agg = trips.groupBy("VehId", "trip_date").agg(
        F.count("Trip").alias("total_trips"),
        F.max("distance_km").alias("max_trip_distance_km"),
        F.min("distance_km").alias("min_trip_distance_km"),
        F.max("max_speed_kmh").alias("max_speed_observed"),
        *_exact_aggs(dist, energy, dur, eff, speed, soc, gain))
    return dist.with_stddev(agg, "stddev_distance_km").select(
        "VehId", "trip_date", "total_trips",
        dist.total().alias("total_distance_km"),
        energy.total().alias("total_energy_consumption"),
        dur.total().alias("total_duration_minutes"),
        eff.rounded_mean(4).alias("avg_efficiency"),
        speed.rounded_mean(2).alias("avg_speed_kmh"),
        soc.rounded_mean(2).alias("avg_battery_soc"),
        "max_trip_distance_km", "min_trip_distance_km",
        "stddev_distance_km",
        "max_speed_observed",
        gain.mean().alias("avg_elevation_gain_m"),
        _now(now).alias("processing_timestamp"),
    ).select(*DAILY_COLUMNS)


def with_route_key(trips: DataFrame) -> DataFrame:
    """Add the four rounded origin/destination coordinates (the route key)."""
    return trips.withColumns(route_key_columns())


ROUTE_MEASURES = (
    _Exact("distance_km", 2), _Exact("total_energy_consumption", 2, squares=True), _Exact("duration_minutes", 2),
    _Exact("efficiency_km_per_energy", 4), _Exact("avg_speed_kmh", 2), _Exact("elevation_gain_m", 2))
TEMPORAL_MEASURES = (
    _Exact("distance_km", 2), _Exact("total_energy_consumption", 2, squares=True), _Exact("avg_speed_kmh", 2),
    _Exact("efficiency_km_per_energy", 4))
TEMPORAL_KEYS = ["trip_dayofweek", "trip_hour"]

#: Decimals of every measure that means are taken of.
MEASURE_SCALES = {"distance_km": 2, "total_energy_consumption": 2, "duration_minutes": 2, "efficiency_km_per_energy": 4,
                  "avg_speed_kmh": 2, "avg_battery_soc": 2, "elevation_gain_m": 2}


def values_out_of_range(trips: DataFrame) -> DataFrame:
    """``measure, n_values``: values too large for exact units (an efficiency over a near-zero
    energy), which means leave out while their trips stay; one aggregate pass."""
    counts = trips.agg(*[F.count_if(out_of_range(c, scale)).alias(c) for c, scale in MEASURE_SCALES.items()])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).alias("n_values")) for c in MEASURE_SCALES]))
    return counts.select(pairs.alias("p")).select("p.measure", "p.n_values").filter("n_values > 0")


def _route_report(agg: DataFrame, min_trips: int, now: Column | None) -> DataFrame:
    """Route columns from summed parts, ``trip_count`` and ``unique_vehicles``."""
    dist, energy, dur, eff, speed, gain = ROUTE_MEASURES
    return energy.with_stddev(agg.filter(F.col("trip_count") >= min_trips), "stddev_energy").select(
        *ROUTE_KEYS, "trip_count",
        dist.rounded_mean(2).alias("avg_distance_km"),
        energy.rounded_mean(2).alias("avg_energy_consumption"),
        dur.mean().alias("avg_duration_minutes"),
        eff.rounded_mean(4).alias("avg_efficiency"),
        speed.rounded_mean(2).alias("avg_speed_kmh"),
        gain.mean().alias("avg_elevation_gain_m"),
        "stddev_energy",
        "unique_vehicles",
        _now(now).alias("processing_timestamp"),
    ).select(*ROUTE_COLUMNS)


def route_patterns(trips: DataFrame, min_trips: int = MIN_ROUTE_TRIPS,
                   now: Column | None = None) -> DataFrame:
    """Trips grouped by rounded origin/destination; routes with >= ``min_trips``.

    ``unique_vehicles`` is a distinct count of vehicles on the route.
    """
    agg = with_route_key(trips).groupBy(*ROUTE_KEYS).agg(
        F.count("Trip").alias("trip_count"),
        F.count_distinct("VehId").alias("unique_vehicles"),
        *_exact_aggs(*ROUTE_MEASURES))
    return _route_report(agg, min_trips, now)


def _temporal_report(agg: DataFrame, now: Column | None) -> DataFrame:
    """Hour-of-week columns from summed parts and ``trip_count``."""
    dist, energy, speed, eff = TEMPORAL_MEASURES
    return energy.with_stddev(agg, "stddev_energy").select(
        *TEMPORAL_KEYS, "trip_count",
        dist.rounded_mean(2).alias("avg_distance_km"),
        energy.rounded_mean(2).alias("avg_energy_consumption"),
        speed.mean().alias("avg_speed_kmh"),
        eff.rounded_mean(4).alias("avg_efficiency"),
        "stddev_energy",
        _now(now).alias("processing_timestamp"),
    ).select(*TEMPORAL_COLUMNS)


def temporal_patterns(trips: DataFrame, now: Column | None = None) -> DataFrame:
    """Per day of week and hour of trip start: trip count, exact means, energy deviation."""
    agg = trips.groupBy(*TEMPORAL_KEYS).agg(F.count("Trip").alias("trip_count"), *_exact_aggs(*TEMPORAL_MEASURES))
    return _temporal_report(agg, now)


# --- the same from stored sums per day ---------------------------------------------------
#
# All the sums behind a group's means and deviations merge by adding, and a set of vehicles
# by OR-ing bitmaps.  Kept per day, they let a refresh replace the days that changed and
# read the trips of no other day; the result is that of a build from all trips, to the bit.

VEHICLE_BUCKET, VEHICLE_BITS = "vehicle_bucket", "vehicles"


def _part_names(measures) -> dict[str, bool]:
    """Columns of the stored sums, and whether each is a struct of square parts."""
    return {f"{m.tag}_{k}": k == "q" for m in measures for k in ("s", "n", *(["q"] if m.squares else []))}


def _added(measures) -> list[Column]:
    """Sums of stored sums, under the same names."""
    return [(F.struct(*[F.sum(F.col(name)[k]).alias(k) for k in SQUARE_PARTS]) if struct else F.sum(name)).alias(name)
            for name, struct in _part_names(measures).items()]


def route_day_parts(trips: DataFrame) -> DataFrame:
    """Per trip date, route and bucket of 32,768 vehicle ids: trips, the bitmap of the
    vehicles, and the sums of every measure.  Ids need not be dense: a bitmap covers the
    ids of its bucket, whatever they are (ids far apart take a bitmap each)."""
    keyed = with_route_key(trips).withColumn(VEHICLE_BUCKET, F.bitmap_bucket_number("VehId"))
    return keyed.groupBy("trip_date", *ROUTE_KEYS, VEHICLE_BUCKET).agg(
        F.count("Trip").alias("trip_count"),
        F.bitmap_construct_agg(F.bitmap_bit_position("VehId")).alias(VEHICLE_BITS),
        *_exact_aggs(*ROUTE_MEASURES))


def route_patterns_from_parts(parts: DataFrame, min_trips: int = MIN_ROUTE_TRIPS, now: Column | None = None) -> DataFrame:
    """``route_patterns`` of the trips behind ``route_day_parts`` of any days.

    The days of a route and bucket are merged first, so the second shuffle carries one
    row for each route and bucket."""
    merged = parts.groupBy(*ROUTE_KEYS, VEHICLE_BUCKET).agg(
        F.sum("trip_count").alias("trip_count"), F.bitmap_or_agg(VEHICLE_BITS).alias(VEHICLE_BITS), *_added(ROUTE_MEASURES))
    # a NULL vehicle has no bucket and counts for none
    distinct = F.sum(F.when(F.col(VEHICLE_BUCKET).isNotNull(), F.bitmap_count(VEHICLE_BITS)).otherwise(F.lit(0)))
    agg = merged.groupBy(*ROUTE_KEYS).agg(
        F.sum("trip_count").alias("trip_count"), distinct.alias("unique_vehicles"), *_added(ROUTE_MEASURES))
    return _route_report(agg, min_trips, now)


def temporal_day_parts(trips: DataFrame) -> DataFrame:
    """Per trip date, day of week and hour: trips and the sums of every measure."""
    return trips.groupBy("trip_date", *TEMPORAL_KEYS).agg(
        F.count("Trip").alias("trip_count"), *_exact_aggs(*TEMPORAL_MEASURES))


def temporal_patterns_from_parts(parts: DataFrame, now: Column | None = None) -> DataFrame:
    """``temporal_patterns`` of the trips behind ``temporal_day_parts`` of any days."""
    agg = parts.groupBy(*TEMPORAL_KEYS).agg(F.sum("trip_count").alias("trip_count"), *_added(TEMPORAL_MEASURES))
    return _temporal_report(agg, now)
