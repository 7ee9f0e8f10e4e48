"""Patterns from stored sums per day, and history computed again only where it can have changed."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, SF_TINY, rows_of
from fleetframe.operators import aggregates, refresh
from fleetframe.operators.features import history_stage
from fleetframe.plans.catalog import read_table, write_table
from fleetframe.plans.inspect import plan_text
from fleetframe.plans.queries import silver
from fleetframe.session import materialize

def now():
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


@pytest.fixture(scope="module")
def trips(spark):
    return materialize(silver(spark, SF_TINY).withColumn("processing_timestamp", now()), "refresh-test")


def _patterns(trips):
    return rows_of(aggregates.route_patterns(trips, now=now())), rows_of(aggregates.temporal_patterns(trips, now()))


def _from_parts(route, temporal):
    return (rows_of(aggregates.route_patterns_from_parts(route, now=now())),
            rows_of(aggregates.temporal_patterns_from_parts(temporal, now())))


@pytest.mark.parametrize("ids", ["VehId * 40000 - 9000000", "IF(VehId % 7 = 2, NULL, VehId)",
                                 "IF(VehId % 2 = 0, 9223372036854775807 - VehId, -VehId * 32768)"])
def test_patterns_from_parts(spark, ids):
    df = materialize(silver(spark, SF_SMALL).withColumn("VehId", F.expr(ids)).withColumn(
        "trip_date", F.when(F.col("Trip") % 5 > 0, F.col("trip_date"))), "refresh-ids")
    route, temporal = aggregates.route_day_parts(df), aggregates.temporal_day_parts(df)
    assert _from_parts(route, temporal) == _patterns(df)
    assert {r["unique_vehicles"] for r in aggregates.route_patterns(df).collect()} != {0}


def test_replaced_days_equal_a_full_build(spark, tmp_dir, trips):
    changed = trips.filter("day(trip_date) % 9 <> 4").withColumn(
        "distance_km", F.when(F.dayofmonth("trip_date") % 5 == 2, F.col("distance_km") * 3).otherwise(F.col("distance_km")))
    dates = sorted(r[0] for r in trips.select("trip_date").distinct().collect())
    touched = [d for d in dates if d.day % 9 == 4 or d.day % 5 == 2]
    assert 0 < len(touched) < len(dates)
    for name, build in (("route_day_parts", aggregates.route_day_parts), ("temporal_day_parts", aggregates.temporal_day_parts)):
        write_table(build(trips), tmp_dir, name)
        from fleetframe.plans.pipeline import PipelineConfig, _refresh_days
        _refresh_days(spark, PipelineConfig("", tmp_dir), name, build(changed.filter(F.col("trip_date").isin(touched))), touched)
    assert _from_parts(read_table(spark, tmp_dir, "route_day_parts"), read_table(spark, tmp_dir, "temporal_day_parts")) \
        == _patterns(changed)


def test_refresh_reads_no_untouched_day(spark, tmp_dir, trips):
    write_table(trips, tmp_dir, "silver_ev_trips")
    stored = read_table(spark, tmp_dir, "silver_ev_trips")
    day = stored.agg(F.max("trip_date")).first()[0]
    for build in (aggregates.route_day_parts, aggregates.temporal_day_parts, aggregates.vehicle_daily_stats):
        df = build(stored.filter(F.col("trip_date").isin([day])))
        assert "PartitionFilters: [isnotnull(trip_date" in plan_text(df, "formatted")
        assert df.inputFiles() and all(f"trip_date={day.isoformat()}" in f for f in stored.filter(
            F.col("trip_date").isin([day])).select(F.input_file_name()).distinct().toPandas().iloc[:, 0])
    merged = aggregates.route_patterns_from_parts(aggregates.route_day_parts(stored))
    assert plan_text(merged).count("Exchange hashpartitioning") <= 4 and "CartesianProduct" not in plan_text(merged)


# --- history -------------------------------------------------------------------------

def _random_trips(rng, n, days=16):
    """(day, vehicle, trip number, route, energy): unique by day, vehicle and trip."""
    keys = {(rng.randint(1, days), rng.choice([1, 2, 2, 2, 3, 4, None]), rng.randint(1, 4)) for _ in range(n)}
    return {k: (rng.randint(0, 4), round(rng.uniform(1, 50), 2)) for k in keys}


def _frame(spark, template, data):
    """Silver rows with the given keys, routes and energies."""
    rows = [(float(d) + 0.25, v, t, dt.date(2017, 10, 31) + dt.timedelta(days=d), float(r), e)
            for (d, v, t), (r, e) in data.items()]
    own = spark.createDataFrame(rows, "DayNum double, VehId long, Trip long, trip_date date, _r double, _e double")
    base = template.limit(1).drop("DayNum", "VehId", "Trip", "trip_date")
    out = own.crossJoin(F.broadcast(base)).withColumns({
        "origin_lat": F.col("_r"), "total_energy_consumption": F.col("_e"),
        "efficiency_km_per_energy": F.round(100 / F.col("_e"), 4)})
    return out.select(*template.columns)


@pytest.mark.parametrize("seed,kind", [(1, "append"), (2, "late"), (3, "removed"), (4, "several")])
def test_refreshed_history_equals_full(spark, tmp_dir, trips, seed, kind):
    rng = random.Random(seed)
    before = _random_trips(rng, 420)
    after = dict(before)
    days = {"append": [17], "late": [4], "removed": [8, 9], "several": [1, 10, 17]}[kind]
    for day in days:
        for key in [k for k in before if k[0] == day]:
            if kind == "removed" or rng.random() < 0.3:
                del after[key]
        for _ in range(0 if kind == "removed" else 6):
            after[(day, rng.choice([1, 2, 5, None]), rng.randint(1, 9))] = (rng.randint(0, 5), round(rng.uniform(1, 50), 2))
    old_rows, new_rows = (materialize(_frame(spark, trips, x), "refresh-rows") for x in (before, after))
    dates = [dt.date(2017, 10, 31) + dt.timedelta(days=d) for d in days]
    write_table(history_stage(old_rows), tmp_dir, "trip_history")
    write_table(new_rows, tmp_dir, "silver_ev_trips")
    stored, old = read_table(spark, tmp_dir, "silver_ev_trips"), read_table(spark, tmp_dir, "trip_history")
    daily, parts = aggregates.vehicle_daily_stats(new_rows), aggregates.route_day_parts(new_rows)
    rows, touched = refresh.refreshed_history(stored, old, daily, parts, dates)
    from fleetframe.plans.pipeline import PipelineConfig, _refresh_days
    _refresh_days(spark, PipelineConfig("", tmp_dir), "trip_history", rows, touched)
    full = history_stage(new_rows)
    got = read_table(spark, tmp_dir, "trip_history")
    assert rows_of(got.select(*full.columns)) == rows_of(full)
    assert set(dates) <= set(touched) and min(touched) == min(dates)
    if kind == "append":
        assert touched == dates


def test_scan_is_bounded(spark, tmp_dir, trips):
    """One new day of one vehicle: of its older trips only the days with the last ones are read."""
    data = {(d, v, 1): (v, 5.0) for d in range(1, 14) for v in (1, 2, 3)}
    data[(14, 1, 1)] = (1, 5.0)
    write_table(_frame(spark, trips, data), tmp_dir, "silver_ev_trips")
    stored = read_table(spark, tmp_dir, "silver_ev_trips")
    first = dt.date(2017, 10, 31) + dt.timedelta(days=14)
    affected = aggregates.with_route_key(stored.filter(F.col("trip_date") == F.lit(first)))
    daily = aggregates.vehicle_daily_stats(stored)
    days = refresh.needed_days(daily, ["VehId"], "total_trips", affected.select("VehId").distinct(), first, 4)
    wanted = [first - dt.timedelta(days=k) for k in range(4, 0, -1)]
    assert sorted(tuple(r) for r in days.collect()) == [(1, d) for d in wanted]
    scope = refresh._scope(stored, affected, ["VehId"], daily, "total_trips", first, 4)
    assert sorted((r["VehId"], r["trip_date"]) for r in scope.collect()) == [(1, d) for d in [*wanted, first]]
    filters = [line for line in plan_text(scope, "formatted").splitlines() if "PartitionFilters" in line]
    assert any(all(str(d) in line or str((d - dt.date(1970, 1, 1)).days) in line for d in wanted) for line in filters)
    assert len(filters) >= 2
