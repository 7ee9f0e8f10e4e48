"""Column builders on hand-written rows (FIXTURES.md section 4)."""

import datetime as dt

from pyspark.sql import functions as F

from fleetframe.functions import (
    clean_numeric, daynum_date, daynum_hour, daynum_minute, distance_category, guarded_ratio,
    haversine_km, hour_sin, is_rush_hour, is_weekend, speed_category, start_datetime_text,
)
from fleetframe.functions.calendar import end_datetime_text
from fleetframe.functions.exact import mean_of, rounded_mean_of, stddev_of, unit_aggs


def _col(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_haversine_edges(spark):
    rows = [(0.0, 0.0, 0.0, 180.0), (0.0, 0.0, 0.0, 90.0), (42.2, -83.7, 42.2, -83.7), (None, 0.0, 1.0, 1.0)]
    got = _col(spark, rows, "a double, b double, c double, d double", haversine_km("a", "b", "c", "d"))
    assert got == [20015.09, 10007.54, 0.0, None]


def test_clean_numeric(spark):
    rows = [("NaN",), ("nan",), ("",), ("  ",), ("abc",), ("1.5",), (" 2 ",), (None,)]
    assert _col(spark, rows, "x string", clean_numeric("x")) == [None, None, None, None, None, 1.5, 2.0, None]


def test_buckets(spark):
    d = [(5.0,), (5.01,), (15.0,), (15.01,), (30.0,), (30.01,), (None,)]
    assert _col(spark, d, "x double", distance_category("x")) == [0.0, 1.0, 1.0, 2.0, 2.0, 3.0, 3.0]
    s = [(30.0,), (30.01,), (60.0,), (60.01,), (None,)]
    assert _col(spark, s, "x double", speed_category("x")) == [0.0, 1.0, 1.0, 2.0, 2.0]


def test_rush_hour_and_weekend(spark):
    hours = [(h,) for h in (6, 7, 9, 10, 16, 17, 19, 20, None)]
    assert _col(spark, hours, "h int", is_rush_hour("h")) == [0, 1, 1, 0, 0, 1, 1, 0, 0]
    days = [(7,), (1,), (2,)]
    assert _col(spark, days, "d int", is_weekend("d")) == [1, 1, 0]


def test_hour_sin(spark):
    assert _col(spark, [(0,), (6,), (12,)], "h int", hour_sin("h")) == [0.0, 1.0, 0.0]


def test_daynum_calendar(spark):
    rows = [(1.0,), (1.5,), (2.015625,)]
    assert _col(spark, rows, "d double", daynum_date("d")) == [dt.date(2017, 11, 1)] * 2 + [dt.date(2017, 11, 2)]
    assert _col(spark, rows, "d double", daynum_hour("d")) == [0, 12, 0]
    assert _col(spark, rows, "d double", daynum_minute("d")) == [0, 0, 22]
    assert _col(spark, rows, "d double", start_datetime_text("d")) == [
        "2017-11-01 00:00:00", "2017-11-01 12:00:00", "2017-11-02 00:22:00"]


def test_end_datetime_crosses_midnight(spark):
    rows = [(1.984375, 2 * 3600 + 5.5)]  # 23:37 plus 2h 0m 5.5s
    got = _col(spark, rows, "d double, s double", end_datetime_text("d", "s"))
    assert got == ["2017-11-02 01:37:05"]


def test_guarded_ratio(spark):
    rows = [(1.0, 0.0), (1.0, None), (None, 2.0), (1.0, 3.0), (1.0, -1.0)]
    got = _col(spark, rows, "n double, d double", guarded_ratio("n", "d", 4))
    assert got == [0.0, 0.0, None, 0.3333, 0.0]


def _exact(spark, values, scale, digits):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    p = unit_aggs("x", scale, squares=True)
    row = df.agg(*[v.alias(k) for k, v in p.items()]).select(
        rounded_mean_of(F.col("s"), F.col("n"), scale, digits).alias("r"),
        mean_of(F.col("s"), F.col("n"), scale).alias("m"),
        stddev_of(F.col("s"), F.col("q"), F.col("n"), scale).alias("sd")).first()
    return row


def test_exact_mean_rounds_half_up(spark):
    assert _exact(spark, [0.16, 0.17], 2, 2)["r"] == 0.17
    assert _exact(spark, [-0.16, -0.17], 2, 2)["r"] == -0.17
    assert _exact(spark, [0.1234, 0.1235], 4, 4)["r"] == 0.1235
    r = _exact(spark, [-0.001], 3, 2)
    assert r["r"] == 0.0 and str(r["r"]) == "0.0"  # no negative zero
    assert _exact(spark, [], 2, 2)["r"] is None


def test_exact_stddev(spark):
    r = _exact(spark, [1.0, 2.0, 3.0, 4.0], 2, 2)
    assert abs(r["sd"] - 1.2909944487358056) < 1e-15
    assert _exact(spark, [5.0], 2, 2)["sd"] is None


def test_exact_is_partition_invariant(spark):
    import random
    rnd = random.Random(7)
    vals = [round(rnd.uniform(-50, 50), 2) for _ in range(2000)]
    df = spark.createDataFrame([(i % 7, v) for i, v in enumerate(vals)], "k int, x double")
    p = unit_aggs("x", 2, squares=True)

    def run(d):
        return sorted(d.groupBy("k").agg(*[v.alias(k) for k, v in p.items()]).select(
            "k", rounded_mean_of(F.col("s"), F.col("n"), 2, 2).alias("r"),
            stddev_of(F.col("s"), F.col("q"), F.col("n"), 2).alias("sd")).collect())

    base = run(df.repartition(1))
    for n in (3, 11, 29):
        assert run(df.repartition(n)) == base
