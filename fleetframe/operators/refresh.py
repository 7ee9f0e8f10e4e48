"""Trip history brought up to date for the trips that a change can have touched.

A trip's history looks at its vehicle's last 30 and its route's last 10 trips before it,
so new or changed trips on some days can only touch

* trips on those days, and
* later trips of the vehicles and routes that have, or had, trips on those days.

To compute these again, the windows need the trips of their vehicles and routes since the
first changed day and, from before it, only the days that hold the last 30 (10) trips of
each.  Which days these are is read from the stored counts per vehicle (route) and day, so
of all older trips only those days are scanned, and only for those keys.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetframe.operators.aggregates import with_route_key
from fleetframe.operators.features import ROUTE_FRAME, VEHICLE_FRAME, engineered, route_history, vehicle_history
from fleetframe.schema import ROUTE_HISTORY_COLUMNS, ROUTE_KEYS, TRIP_KEYS, VEHICLE_HISTORY_COLUMNS
from fleetframe.session import materialize


def _matching(left: DataFrame, right: DataFrame, keys, how: str) -> DataFrame:
    """Join on ``keys``, NULL equal to NULL; the columns of ``left`` only for semi and anti."""
    l, r = left.alias("l"), right.alias("r")
    return l.join(r, reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]), how)


def _on(dates: list[dt.date | None]) -> Column:
    """Condition on ``trip_date`` (a partition column: other folders are not listed)."""
    known = [d for d in dates if d is not None]
    out = F.col("trip_date").isin(known) if known else F.lit(False)
    return out | F.col("trip_date").isNull() if None in dates else out


def affected_trips(silver: DataFrame, old: DataFrame, dates: list[dt.date]) -> DataFrame:
    """Trips (silver columns and route key) whose history the trips on ``dates`` can have
    changed; ``old`` is the history before the change."""
    keyed = with_route_key(silver.filter(F.col("trip_date") >= F.lit(min(dates))))
    columns = ["VehId", *ROUTE_KEYS]
    changed = keyed.filter(_on(dates)).select(*columns).unionByName(old.filter(_on(dates)).select(*columns))
    changed = materialize(changed.distinct(), "changed-keys")
    vehicles = changed.select("VehId").distinct()
    routes = changed.select(*ROUTE_KEYS).distinct()
    of_vehicles = _matching(keyed, vehicles, ["VehId"], "left_semi")
    of_routes = _matching(_matching(keyed, vehicles, ["VehId"], "left_anti"), routes, ROUTE_KEYS, "left_semi")
    return of_vehicles.unionByName(of_routes)


def needed_days(counts: DataFrame, keys, count_column: str, wanted: DataFrame, first: dt.date, frame: int) -> DataFrame:
    """(key, trip_date) of the days before ``first`` that hold the last ``frame`` trips of
    each wanted key.  ``counts`` has one row or more per key and day."""
    before = F.col("trip_date").isNull() | (F.col("trip_date") < F.lit(first))
    per_day = _matching(counts.filter(before), wanted, keys, "left_semi") \
        .groupBy(*keys, "trip_date").agg(F.sum(count_column).alias("n"))
    later = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("trip_date")).rowsBetween(
        Window.unboundedPreceding, -1)
    return per_day.withColumn("newer", F.coalesce(F.sum("n").over(later), F.lit(0).cast("long"))) \
        .filter(F.col("newer") < frame).select(*keys, "trip_date")


def _scope(silver: DataFrame, affected: DataFrame, keys, counts: DataFrame, count_column: str, first: dt.date,
           frame: int) -> DataFrame:
    """All trips that the windows of the affected keys need."""
    wanted = affected.select(*keys).distinct()
    days = materialize(needed_days(counts, keys, count_column, wanted, first, frame), "needed-days")
    dates = [r[0] for r in days.select("trip_date").distinct().collect()]  # calendar days
    older = _matching(with_route_key(silver.filter(_on(dates))), days, [*keys, "trip_date"], "left_semi")
    newer = with_route_key(silver.filter(F.col("trip_date") >= F.lit(first)))
    return older.unionByName(_matching(newer, wanted, keys, "left_semi"))


def refreshed_history(silver: DataFrame, old: DataFrame, daily: DataFrame, route_parts: DataFrame,
                      dates: list[dt.date], chunks: int | None = None) -> tuple[DataFrame, list]:
    """New rows of the history table for every partition that changes, and their dates.

    ``silver``, ``daily`` (vehicle and day counts) and ``route_parts`` are the tables after
    the change, ``old`` the history before it.  Partitions not in the returned list stay
    as they are; ``dates`` without trips any more are not in the rows."""
    first = min(dates)
    affected = materialize(affected_trips(silver, old, dates), "affected-trips")
    touched = sorted({*dates, *(r[0] for r in affected.select("trip_date").distinct().collect())})  # calendar days
    vehicle_scope = materialize(_scope(silver, affected, ["VehId"], daily, "total_trips", first, VEHICLE_FRAME), "vehicle-scope")
    route_scope = materialize(_scope(silver, affected, ROUTE_KEYS, route_parts, "trip_count", first, ROUTE_FRAME), "route-scope")
    vehicles = vehicle_history(vehicle_scope, chunks).select(*TRIP_KEYS, *VEHICLE_HISTORY_COLUMNS)
    routes = route_history(route_scope, chunks).select(*TRIP_KEYS, *ROUTE_HISTORY_COLUMNS)
    with_vehicles = _matching(affected, vehicles, TRIP_KEYS, "inner").select("l.*", *[f"r.{c}" for c in VEHICLE_HISTORY_COLUMNS])
    new = _matching(with_vehicles, routes, TRIP_KEYS, "inner").select("l.*", *[f"r.{c}" for c in ROUTE_HISTORY_COLUMNS])
    new = engineered(new).select(*old.columns)
    kept = _matching(old.filter(_on([d for d in touched if d not in dates])), affected, TRIP_KEYS, "left_anti")
    return kept.select(*old.columns).unionByName(new), touched
