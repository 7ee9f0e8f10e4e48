"""Trip table edge cases on hand-written samples."""

from conftest import rows_of
from pyspark.sql import types as T

from fleetframe.operators.trips import build_trips, ev_trip_aggregates, trip_measures
from fleetframe.operators.vehicles import ev_vehicles, vehicle_signals
from fleetframe.schema import SAMPLE_COLUMNS, SAMPLE_TYPES

SCHEMA = T.StructType([T.StructField(c, SAMPLE_TYPES[c], True) for c in SAMPLE_COLUMNS])


def samples(spark, rows):
    """rows: dicts; unspecified signals NULL, battery SOC present (an EV)."""
    full = []
    for r in rows:
        d = {c: None for c in SAMPLE_COLUMNS}
        d.update({"battery_soc_pct": 50.0, "energy": 1.0, "speed_kmh": 10.0, "elevation_m": 100.0})
        d.update(r)
        full.append(tuple(d[c] for c in SAMPLE_COLUMNS))
    return spark.createDataFrame(full, SCHEMA)


def trip(vid=1, day=1.5, t=1, **kw):
    return {"VehId": vid, "DayNum": day, "Trip": t, **kw}


def test_classification(spark):
    df = samples(spark, [
        trip(vid=1, ts_ms=0, lat=0.0, lon=0.0),
        trip(vid=2, ts_ms=0, fuel_rate_lph=1.0),                    # hybrid
        trip(vid=3, ts_ms=0, battery_soc_pct=None),                 # no battery signal
        trip(vid=4, ts_ms=0, battery_soc_pct=None, battery_voltage_v=350.0),
    ])
    flags = {r["VehId"]: (r["has_combustion"], r["has_battery"]) for r in vehicle_signals(df).collect()}
    assert flags == {1: (0, 1), 2: (1, 1), 3: (0, 0), 4: (0, 1)}
    assert sorted(r["VehId"] for r in ev_vehicles(df).collect()) == [1, 4]


def test_endpoints_ties_and_null_times(spark):
    df = samples(spark, [
        trip(ts_ms=None, lat=10.0, lon=10.0),     # never first or last
        trip(ts_ms=100, lat=1.0, lon=2.0),
        trip(ts_ms=100, lat=1.0, lon=3.0),        # tie on time: same sample's lat and lon
        trip(ts_ms=5000, lat=1.5, lon=2.5),
    ])
    row = trip_measures(ev_trip_aggregates(df)).first()
    assert (row["origin_lat"], row["origin_lon"]) in ((1.0, 2.0), (1.0, 3.0))
    assert (row["destination_lat"], row["destination_lon"]) == (1.5, 2.5)
    assert row["start_timestamp_ms"] == 100 and row["end_timestamp_ms"] == 5000
    assert row["trip_count"] == 4 and row["duration_seconds"] == 4.9


def test_quality_rules_and_zero_energy(spark):
    df = samples(spark, [
        trip(t=1, ts_ms=0, lat=1.0, lon=1.0),                      # single sample: zero duration
        trip(t=2, ts_ms=0, lat=1.0, lon=1.0, energy=0.0),
        trip(t=2, ts_ms=60000, lat=1.0, lon=1.0, energy=0.0),      # round trip, zero energy
        trip(t=3, ts_ms=None, lat=1.0, lon=1.0),                   # no time at all
    ])
    out = {r["Trip"]: r for r in build_trips(df).collect()}
    assert set(out) == {2}
    assert out[2]["distance_km"] == 0.0
    assert out[2]["efficiency_km_per_energy"] is None
    assert out[2]["duration_minutes"] == 1.0


def test_broadcast_and_shuffle_plans_agree(spark):
    from conftest import SF_TINY
    from fleetframe.plans.queries import samples as tele
    s = tele(spark, SF_TINY)
    cols = [c for c in build_trips(s).columns if c != "processing_timestamp"]
    broadcast_rows = rows_of(build_trips(s).select(*cols))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        shuffle_rows = rows_of(build_trips(s).select(*cols))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert broadcast_rows == shuffle_rows and len(broadcast_rows) > 0
