"""Gold and feature edge cases on hand-written trips (FIXTURES.md section 4)."""

import datetime as dt

from pyspark.sql import types as T

from fleetframe.operators.aggregates import route_patterns, temporal_patterns, vehicle_daily_stats
from fleetframe.operators.features import build_features, engineered, vehicle_history
from fleetframe.schema import SILVER_COLUMNS

_TYPES = {"DayNum": T.DoubleType(), "VehId": T.LongType(), "Trip": T.LongType(),
          "trip_date": T.DateType(), "trip_start_datetime": T.StringType(),
          "trip_end_datetime": T.StringType(), "start_timestamp_ms": T.LongType(),
          "end_timestamp_ms": T.LongType(), "trip_year": T.IntegerType(),
          "trip_month": T.IntegerType(), "trip_dayofweek": T.IntegerType(),
          "trip_hour": T.IntegerType(), "trip_count": T.LongType(),
          "processing_timestamp": T.TimestampType()}
SCHEMA = T.StructType([T.StructField(c, _TYPES.get(c, T.DoubleType()), True) for c in SILVER_COLUMNS])


def trips(spark, rows):
    base = {c: None for c in SILVER_COLUMNS}
    base.update({"trip_date": dt.date(2017, 11, 1), "trip_year": 2017, "trip_month": 11,
                 "trip_dayofweek": 4, "trip_hour": 8, "distance_km": 1.0, "duration_minutes": 10.0,
                 "duration_seconds": 600.0, "total_energy_consumption": 2.0,
                 "efficiency_km_per_energy": 0.5, "avg_speed_kmh": 30.0, "max_speed_kmh": 50.0,
                 "avg_battery_soc": 80.0, "min_battery_soc": 70.0, "max_battery_soc": 90.0,
                 "elevation_gain_m": 3.0, "origin_lat": 42.2, "origin_lon": -83.7,
                 "destination_lat": 42.3, "destination_lon": -83.6, "trip_count": 10})
    out = []
    for r in rows:
        d = dict(base)
        d.update(r)
        out.append(tuple(d[c] for c in SILVER_COLUMNS))
    return spark.createDataFrame(out, SCHEMA)


def test_route_needs_three_trips(spark):
    rows = [{"VehId": 1, "Trip": i, "DayNum": 1.0 + i} for i in range(3)]
    rows += [{"VehId": 2, "Trip": i, "DayNum": 1.0 + i, "origin_lat": 40.0} for i in range(2)]
    got = route_patterns(trips(spark, rows)).collect()
    assert len(got) == 1 and got[0]["origin_lat_rounded"] == 42.2 and got[0]["trip_count"] == 3
    assert got[0]["unique_vehicles"] == 1


def test_daily_and_temporal_single_trip(spark):
    df = trips(spark, [{"VehId": 1, "Trip": 1, "DayNum": 1.5}])
    d = vehicle_daily_stats(df).first()
    assert d["total_trips"] == 1 and d["stddev_distance_km"] is None and d["avg_efficiency"] == 0.5
    t = temporal_patterns(df).first()
    assert t["trip_count"] == 1 and t["stddev_energy"] is None


def test_second_trip_has_no_deviation_yet(spark):
    df = trips(spark, [{"VehId": 1, "Trip": 1, "DayNum": 1.5, "total_energy_consumption": 1.0},
                       {"VehId": 1, "Trip": 2, "DayNum": 2.5, "total_energy_consumption": 3.0},
                       {"VehId": 1, "Trip": 3, "DayNum": 3.5, "total_energy_consumption": 5.0}])
    rows = {r["Trip"]: r for r in vehicle_history(df).collect()}
    assert rows[1]["vehicle_trip_count_last30"] == 0 and rows[1]["vehicle_avg_energy_last30"] is None
    assert rows[2]["vehicle_avg_energy_last30"] == 1.0 and rows[2]["vehicle_stddev_energy_last30"] is None
    assert rows[3]["vehicle_avg_energy_last30"] == 2.0 and rows[3]["vehicle_stddev_energy_last30"] == 1.41


def test_zero_distance_and_duration_ratios(spark):
    df = trips(spark, [{"VehId": 1, "Trip": 1, "DayNum": 1.5, "distance_km": 0.0,
                        "duration_minutes": 0.0, "max_speed_kmh": None}])
    r = engineered(df).first()
    for col in ("speed_per_distance", "duration_per_distance", "elevation_gradient",
                "actual_speed_efficiency", "battery_usage_rate", "energy_per_km",
                "elevation_per_minute", "speed_efficiency_ratio"):
        assert r[col] == 0.0, col
    assert r["distance_category"] == 0.0 and r["speed_variability"] is None


def test_training_rows_need_history(spark):
    rows = [{"VehId": 1, "Trip": i, "DayNum": 1.0 + i, "total_energy_consumption": float(i + 1)}
            for i in range(8)]
    out = build_features(trips(spark, rows)).collect()
    # trips 0..4 have < 5 prior trips; 5, 6, 7 qualify (route seen before too)
    assert sorted(r["Trip"] for r in out) == [5, 6, 7]
    assert all(r["target_energy_consumption"] == r["Trip"] + 1 for r in out)
