"""Inputs that used to be lost or to stop a job: odd ids, wide headers, odd files, extreme values."""

import bz2
import statistics

import pytest
from pyspark.sql import Window, functions as F

from conftest import SF_SMALL
from fleetframe.functions.exact import rounded_mean_of, stddev_of, unit_aggs, unit_values
from fleetframe.operators.cleaning import clean_telemetry
from fleetframe.operators.history import trailing_sums
from fleetframe.operators.trips import fix_order
from fleetframe.plans.queries import REGISTRY
from fleetframe.session import materialize
from fleetframe.sources.csv import header_groups, list_csv_files, read_header, read_telemetry_csv
from fleetframe.streaming.ingest import run_ingest


def test_float_formatted_ids(spark):
    raw = spark.createDataFrame([("8.0", "1E3", "5", "1.0"), ("8.5", "x", None, " 7 ")],
                                "VehId string, Trip string, DayNum string, `Timestamp(ms)` string")
    got = [tuple(r) for r in clean_telemetry(raw).select("VehId", "Trip", "ts_ms").collect()]
    assert got == [(8, 1000, 1), (None, None, 7)]


def test_wide_header(spark, tmp_path):
    columns = [f"extra_signal_with_a_long_name_{i}" for i in range(5015)]
    path = tmp_path / "a.csv"
    path.write_text(",".join(columns) + "\n")
    assert list(read_header(str(path))) == columns


def test_listing_follows_spark(spark, tmp_path):
    (tmp_path / "a.csv").write_text("VehId,Trip\n1,1\n")
    (tmp_path / "b.csv.bz2").write_bytes(bz2.compress(b"VehId,Trip\n2,1\n"))
    (tmp_path / "c.csv").write_text("\nVehId,Trip\n3,1\n")
    (tmp_path / "_temporary" / "0").mkdir(parents=True)
    (tmp_path / "_temporary" / "0" / "x.csv").write_text("VehId,Trip\n9,9\n")
    assert [f.rsplit("/", 1)[1] for f in list_csv_files(str(tmp_path))] == ["a.csv", "b.csv.bz2", "c.csv"]
    assert sorted(r.VehId for r in read_telemetry_csv(spark, str(tmp_path)).collect()) == ["1", "2", "3"]


def test_one_header_path(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"x\x1fy",z\n')
    (tmp_path / "b.csv").write_text('""\n')
    files = list_csv_files(str(tmp_path))
    assert header_groups(files) == {("x\x1fy", "z"): [files[0]], ("",): [files[1]]}


def test_ingested_rows_with_short_progress_list(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for i in range(8):
        (source / f"{i}.csv").write_text(f"VehId,Trip\n{i},1\n")
    key = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(key)
    spark.conf.set(key, "3")
    try:
        run = lambda: run_ingest(spark, str(source), str(tmp_path / "out"), str(tmp_path / "ckpt"),
                                 max_files_per_trigger=1)
        assert run() == 8
        assert run() == 0
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_exact_means_do_not_overflow(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        aggs = unit_aggs("x", 4)
        got = spark.createDataFrame([(4.0e17,), (2.0,), (4.0,)], "x double").agg(
            aggs["s"].alias("s"), aggs["n"].alias("n")).select(rounded_mean_of(F.col("s"), F.col("n"), 4, 4)).first()[0]
        assert got == 3.0  # the value beyond a long's range has no units
        wide = spark.range(1).select(rounded_mean_of(F.lit(10 ** 15), F.lit(10 ** 9), 4, 4)).first()[0]
        assert wide == 100.0
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_history_sums_do_not_overflow(spark):
    df = spark.createDataFrame([(1, i, 4.0e14) for i in range(6)], "k long, o long, x double")
    for profile in ((0, 6), (1 << 60, 6)):  # plain and split plan; units of 4e18 each
        out = trailing_sums(df, ["k"], ["o"], 4, unit_values("x", 4), wide={"s"}, chunks=2, profile=profile)
        means = out.select("o", rounded_mean_of(F.col("s"), F.col("n"), 4, 4)).orderBy("o").collect()
        assert [r[1] for r in means] == [None] + [4.0e14] * 5


@pytest.mark.parametrize("name, keys", [("vehicle_daily_stats", ["VehId", "trip_date"]),
                                        ("temporal_patterns", ["trip_dayofweek", "trip_hour"])])
def test_means_and_deviations_against_plain_floats(spark, name, keys):
    """Plain floating means of the silver rows, without integer units."""
    trips = REGISTRY["silver_trips"](spark, SF_SMALL).toPandas()
    got = REGISTRY[name](spark, SF_SMALL).toPandas().set_index(keys).sort_index()
    groups = trips.groupby(keys)
    columns = {"vehicle_daily_stats": {
        "avg_efficiency": ("efficiency_km_per_energy", "mean"), "avg_speed_kmh": ("avg_speed_kmh", "mean"),
        "avg_battery_soc": ("avg_battery_soc", "mean"), "stddev_distance_km": ("distance_km", "std"),
        "total_distance_km": ("distance_km", "sum"), "avg_elevation_gain_m": ("elevation_gain_m", "mean"),
    }, "temporal_patterns": {
        "avg_distance_km": ("distance_km", "mean"), "avg_energy_consumption": ("total_energy_consumption", "mean"),
        "avg_speed_kmh": ("avg_speed_kmh", "mean"), "stddev_energy": ("total_energy_consumption", "std"),
    }}[name]
    assert len(got) == groups.ngroups > 0
    for column, (source, kind) in columns.items():
        plain = groups[source].agg(kind).sort_index()
        assert (plain.isna() == got[column].isna()).all(), column
        assert ((plain - got[column]).abs().dropna() <= 0.0051).all(), column


def test_time_beyond_the_key_is_an_error(spark):
    df = spark.createDataFrame([(1 << 43, 1.0, 2.0)], "ts_ms long, lat double, lon double")
    with pytest.raises(Exception, match="out of range"):
        df.select(fix_order()).collect()
    assert df.select(F.lit(None).cast("long").alias("ts_ms"), "lat", "lon").select(fix_order()).first()[0] is None


def test_odd_file_names(spark, tmp_path):
    (tmp_path / "a[1] {x}.csv").write_text("VehId,Trip\n1,1\n")
    (tmp_path / "b 50%.csv").write_text("Trip,VehId\n1,2\n")
    assert sorted(r.VehId for r in read_telemetry_csv(spark, str(tmp_path)).collect()) == ["1", "2"]
    assert run_ingest(spark, str(tmp_path), str(tmp_path / "_out"), str(tmp_path / "_ckpt")) == 2


def test_paths_keep_scheme_and_authority(spark):
    from fleetframe.sources.files import qualified
    assert qualified("/data/in").startswith("file:/")
    context = spark.sparkContext
    for path in ("hdfs://nn:8020/data/in", "s3a://bucket/key", "abfss://c@account.dfs.core.windows.net/p"):
        assert context._jvm.org.apache.hadoop.fs.Path(path).toString() == path


def test_small_files_are_replaced_whole(spark, tmp_path):
    from fleetframe.sources.files import path_exists, read_text, replace_dir, write_text
    path = str(tmp_path / "state" / "s.json")
    for text in ("one", "two é"):
        write_text(path, text)
        assert read_text(path) == text
    write_text(str(tmp_path / "new" / "x"), "x")
    replace_dir(str(tmp_path / "new"), str(tmp_path / "state"))
    assert path_exists(str(tmp_path / "state" / "x")) and not path_exists(path)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_deviations_of_any_size(spark, ansi):
    """Against exact fractions: extreme values, a narrow spread around a half's edge, large equal values."""
    from fractions import Fraction
    groups = [[7.5e16 + k for k in (0, 16, 1024, 65536, 0, 0)], [9.2e16, -9.2e16, 1.0, 2.0], [42949672.95 + k / 100 for k in range(9)],
              [-42949672.97 + k / 100 for k in range(6)], [9.0e16] * 5, [21474836.47, 21474836.48], [5.0, 5.0, None], [9.1e16, -9.1e16] * 40,
              [None, None], [1.0], [9.0e16, 0.01]]
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(g, i, v) for g, vs in enumerate(groups) for i, v in enumerate(vs)], "g int, i int, x double")
        aggs = unit_aggs("x", 2, squares=True)
        got = {r.g: r.sd for r in df.repartition(7).groupBy("g").agg(*[v.alias(k) for k, v in aggs.items()]).select(
            "g", stddev_of(F.col("s"), F.col("q"), F.col("n"), 2).alias("sd")).collect()}
        for g, values in enumerate(groups):
            units = [round(Fraction(v) * 100) if abs(v) < 1e9 else int(v * 100) for v in values if v is not None]
            if len(units) < 2:
                assert got[g] is None
                continue
            mean = Fraction(sum(units), len(units))
            variance = sum((u - mean) ** 2 for u in units) / (len(units) - 1)
            assert got[g] == pytest.approx(float(variance) ** 0.5 / 100, rel=1e-12), g
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_extreme_energies_reach_every_table(spark, ansi):
    """Six trips of 7.5e16 energy (one bad sensor) among ordinary ones, on one route and vehicle."""
    from fleetframe.operators import aggregates, features
    trips = REGISTRY["silver_trips"](spark, SF_SMALL).withColumn("VehId", F.lit(2).cast("long")) \
        .withColumns({c: F.lit(1.0) for c in ("origin_lat", "origin_lon", "destination_lat", "destination_lon")})
    rank = F.row_number().over(Window.orderBy("DayNum", "Trip", "distance_km"))
    trips = trips.withColumn("Trip", rank.cast("long")).withColumn(
        "total_energy_consumption", F.when(F.col("Trip").between(10, 15), 7.5e16).otherwise(F.coalesce("total_energy_consumption", F.lit(1.25)))) \
        .withColumn("efficiency_km_per_energy", F.when(F.col("Trip").between(40, 70), 9.0e14).otherwise(F.col("efficiency_km_per_energy"))) \
        .withColumn("processing_timestamp", F.current_timestamp())
    trips = materialize(trips, "extreme")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        energy = sorted(r[0] for r in trips.select("total_energy_consumption").collect())
        route = aggregates.route_patterns(trips).collect()
        assert len(route) == 1 and route[0]["stddev_energy"] == pytest.approx(statistics.stdev(energy), rel=1e-9)
        hours = aggregates.temporal_patterns(trips).collect()
        assert sum(r["trip_count"] for r in hours) == len(energy) and max(r["stddev_energy"] or 0 for r in hours) > 1e15
        assert len(aggregates.vehicle_daily_stats(trips).collect()) > 0
        table = {r["Trip"]: r for r in features.build_features(trips).collect()}
        own = {r["Trip"]: r for r in trips.collect()}
        assert set(table) == set(range(6, len(energy) + 1))
        for t in (16, 30, 45, 46, 60, 100, len(energy)):
            last = [own[k]["total_energy_consumption"] for k in range(max(1, t - 30), t)]
            assert table[t]["vehicle_stddev_energy_last30"] == pytest.approx(statistics.stdev(last), rel=1e-9, abs=0.006)
            assert table[t]["vehicle_avg_energy_last30"] == pytest.approx(statistics.fmean(last), rel=1e-9, abs=0.006)
            efficiency = [v for k in range(max(1, t - 30), t) if (v := own[k]["efficiency_km_per_energy"]) is not None]
            assert table[t]["vehicle_avg_efficiency_last30"] == pytest.approx(statistics.fmean(efficiency), rel=1e-9, abs=6e-5)
        fleet = statistics.fmean(r["vehicle_avg_efficiency_last30"] for r in features.history_stage(trips).collect()
                                 if r["vehicle_avg_efficiency_last30"] is not None)
        some = table[20]
        assert some["vehicle_efficiency_vs_fleet"] == pytest.approx(some["vehicle_avg_efficiency_last30"] - fleet, rel=1e-9)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_values_out_of_range_are_counted(spark):
    from fleetframe.operators.aggregates import MEASURE_SCALES, values_out_of_range
    rows = [(1e300, 1.0), (9.3e16, -1e17), (9.2e16, None), (None, 9.2e14), (1.0, 9.3e14)]
    df = spark.createDataFrame(rows, "total_energy_consumption double, efficiency_km_per_energy double") \
        .withColumns({c: F.lit(1.0) for c in MEASURE_SCALES if c not in ("total_energy_consumption", "efficiency_km_per_energy")})
    assert {tuple(r) for r in values_out_of_range(df).collect()} == {("total_energy_consumption", 2), ("efficiency_km_per_energy", 2)}
    assert values_out_of_range(df.limit(0)).count() == 0
