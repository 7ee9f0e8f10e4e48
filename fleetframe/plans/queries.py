"""Named queries over the driver's test tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each one runs a library operator over whole tables (no row caps).  Columns
that are unrounded floating aggregates in the library's tables are rounded
here as well, so that an independent engine with a different summation
order can be compared value by value; the library tables themselves keep
their documented columns.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetframe.functions.buckets import distance_category
from fleetframe.functions.calendar import daynum_minute
from fleetframe.functions.exact import SQUARE_PARTS, rounded_mean_of, sum_of, unit_values, units, with_stddev
from fleetframe.operators import aggregates, features, history
from fleetframe.operators.cleaning import RESCUED, clean_telemetry, rescued_counts
from fleetframe.operators.joins import sized_for_broadcast
from fleetframe.operators.quality import STRICT_RULES, expect_or_drop, rule_metrics
from fleetframe.operators.trips import build_trips, ev_trip_aggregates, trip_measures
from fleetframe.operators.vehicles import ev_vehicles, vehicle_signals
from fleetframe.plans.catalog import describe_table, read_table as read_table_of, schema_log_path, table_path, write_table
from fleetframe.schema import (
    BATTERY_COLUMNS, CATEGORY_COLUMNS, COMPLEXITY_COLUMNS, INTERACTION_COLUMNS, RATIO_COLUMNS,
    RAW_COLUMNS, ROUTE_HISTORY_COLUMNS, ROUTE_KEYS, SAMPLE_COLUMNS, SILVER_COLUMNS, TIME_COLUMNS,
    TRIP_KEYS, VEHICLE_HISTORY_COLUMNS,
)
from fleetframe.session import materialize, scratch_path
from fleetframe.sources.csv import read_telemetry_csv, write_csv
from fleetframe.sources.schema_log import SchemaLog
from fleetframe.sources.testbed import read_table, telemetry
from fleetframe.streaming.ingest import run_ingest, typed_samples

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register ``fn`` under its name (a ``q_`` prefix is dropped)."""
    name = fn.__name__
    REGISTRY[name[2:] if name.startswith("q_") else name] = fn
    return fn


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_telemetry(telemetry(spark, sf_dir))


def all_ev_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EV trips with every derived column, before quality rules."""
    return trip_measures(ev_trip_aggregates(samples(spark, sf_dir)))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_trips(samples(spark, sf_dir))


def written_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver, written first: the history operator measures its keys before it runs."""
    return materialize(silver(spark, sf_dir), "silver")


# --- raw and cleaned samples -------------------------------------------------

@query
def telemetry_view(spark, sf_dir):
    return telemetry(spark, sf_dir)


@query
def clean_signals(spark, sf_dir):
    return samples(spark, sf_dir)


# --- vehicles ----------------------------------------------------------------

@query
def vehicle_classes(spark, sf_dir):
    return vehicle_signals(samples(spark, sf_dir))


@query
def q_ev_vehicles(spark, sf_dir):
    return ev_vehicles(samples(spark, sf_dir)).orderBy("VehId")


@query
def ev_telemetry_semi_join(spark, sf_dir):
    s = samples(spark, sf_dir)
    keys, fits = sized_for_broadcast(ev_vehicles(s).select("VehId"), 32, "ev-vehicles")
    return s.join(F.broadcast(keys) if fits else keys, "VehId", "left_semi").select(*SAMPLE_COLUMNS)


# --- trip parts ----------------------------------------------------------------

@query
def trip_bounds(spark, sf_dir):
    return all_ev_trips(spark, sf_dir).select(
        *TRIP_KEYS, "start_timestamp_ms", "end_timestamp_ms", "trip_count",
        "duration_seconds", "duration_minutes")


@query
def trip_endpoints(spark, sf_dir):
    return all_ev_trips(spark, sf_dir).select(
        *TRIP_KEYS, "origin_lat", "origin_lon", "destination_lat", "destination_lon")


@query
def trip_signal_stats(spark, sf_dir):
    return all_ev_trips(spark, sf_dir).select(
        *TRIP_KEYS, "total_energy_consumption", "avg_battery_soc", "min_battery_soc",
        "max_battery_soc", "avg_battery_voltage", "avg_speed_kmh", "max_speed_kmh",
        "avg_elevation_m", "max_elevation_m", "min_elevation_m")


@query
def trip_calendar(spark, sf_dir):
    return all_ev_trips(spark, sf_dir).select(
        *TRIP_KEYS, "trip_date", "trip_year", "trip_month", "trip_dayofweek", "trip_hour",
        daynum_minute("DayNum").alias("trip_minute"))


@query
def trip_datetimes(spark, sf_dir):
    return all_ev_trips(spark, sf_dir).select(
        *TRIP_KEYS, "duration_seconds", "trip_start_datetime", "trip_end_datetime")


@query
def trip_distance(spark, sf_dir):
    return all_ev_trips(spark, sf_dir).select(*TRIP_KEYS, "distance_km", "duration_minutes")


@query
def trip_efficiency(spark, sf_dir):
    return all_ev_trips(spark, sf_dir).select(
        *TRIP_KEYS, "distance_km", "total_energy_consumption", "efficiency_km_per_energy",
        "elevation_gain_m")


# --- quality -----------------------------------------------------------------

@query
def quality_filtered_trips(spark, sf_dir):
    return expect_or_drop(all_ev_trips(spark, sf_dir), STRICT_RULES).select(
        *TRIP_KEYS, "distance_km", "total_energy_consumption", "duration_seconds")


@query
def quality_metrics(spark, sf_dir):
    return rule_metrics(all_ev_trips(spark, sf_dir), STRICT_RULES)


@query
def silver_trips(spark, sf_dir):
    return silver(spark, sf_dir).select(*[c for c in SILVER_COLUMNS if c != "processing_timestamp"])


# --- gold summaries ------------------------------------------------------------

def _round_cols(df: DataFrame, names, scale: int = 4) -> DataFrame:
    """Round unrounded floating aggregates for cross-engine comparison."""
    return df.withColumns({n: F.round(n, scale) for n in names})


@query
def vehicle_daily_stats(spark, sf_dir):
    out = aggregates.vehicle_daily_stats(silver(spark, sf_dir)).drop("processing_timestamp")
    return _round_cols(out, ["total_duration_minutes", "stddev_distance_km", "avg_elevation_gain_m"])


@query
def route_patterns(spark, sf_dir):
    out = aggregates.route_patterns(silver(spark, sf_dir)).drop("processing_timestamp")
    return _round_cols(out, ["avg_duration_minutes", "avg_elevation_gain_m", "stddev_energy"])


@query
def temporal_patterns(spark, sf_dir):
    out = aggregates.temporal_patterns(silver(spark, sf_dir)).drop("processing_timestamp")
    return _round_cols(out, ["avg_speed_kmh", "stddev_energy"])


# --- history and features ----------------------------------------------------------

@query
def vehicle_history_30(spark, sf_dir):
    return features.vehicle_history(written_silver(spark, sf_dir)).select(*TRIP_KEYS, *VEHICLE_HISTORY_COLUMNS)


@query
def route_history_10(spark, sf_dir):
    keyed = aggregates.with_route_key(written_silver(spark, sf_dir))
    return features.route_history(keyed).select(*TRIP_KEYS, *ROUTE_KEYS, *ROUTE_HISTORY_COLUMNS)


@query
def fleet_comparison(spark, sf_dir):
    hist = materialize(features.vehicle_history(written_silver(spark, sf_dir)), "vehicle-history")
    return features.with_fleet_comparison(hist).select(
        *TRIP_KEYS, "vehicle_avg_efficiency_last30", "vehicle_efficiency_vs_fleet")


def _engineered(spark, sf_dir, columns):
    return features.engineered(aggregates.with_route_key(silver(spark, sf_dir))).select(*TRIP_KEYS, *columns)


@query
def interaction_features(spark, sf_dir):
    return _engineered(spark, sf_dir, INTERACTION_COLUMNS)


@query
def ratio_features(spark, sf_dir):
    return _engineered(spark, sf_dir, RATIO_COLUMNS)


@query
def battery_features(spark, sf_dir):
    return _engineered(spark, sf_dir, BATTERY_COLUMNS)


@query
def complexity_features(spark, sf_dir):
    return _engineered(spark, sf_dir, COMPLEXITY_COLUMNS)


@query
def time_features(spark, sf_dir):
    return _engineered(spark, sf_dir, ["trip_hour", "trip_dayofweek", *TIME_COLUMNS])


@query
def category_features(spark, sf_dir):
    return _engineered(spark, sf_dir, ["distance_km", "avg_speed_kmh", *CATEGORY_COLUMNS])


@query
def vehicle_distance_class(spark, sf_dir):
    """Distance by vehicle and weekday, by vehicle (no weekday) and in all, with its
    distance bucket: the sums reach the buckets over 5 km."""
    total = sum_of(F.sum(units("distance_km", 2).cast("decimal(38,0)")), 2)
    keys = ["VehId", "trip_dayofweek"]
    return (silver(spark, sf_dir).rollup(*keys).agg(total.alias("total_distance_km"))
            .select(*keys, "total_distance_km", distance_category("total_distance_km").alias("distance_category")))


def feature_rows(spark, sf_dir):
    return features.build_features(silver(spark, sf_dir))


@query
def feature_table(spark, sf_dir):
    return feature_rows(spark, sf_dir).drop("feature_timestamp")


@query
def key_check(spark, sf_dir):
    """Declared key constraints of the feature table: expect zero violations."""
    per_key = feature_rows(spark, sf_dir).groupBy(*TRIP_KEYS).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("VehId").isNull(), F.col("n"))), F.lit(0).cast("long")).alias("null_vehid"),
        F.coalesce(F.sum(F.when(F.col("Trip").isNull(), F.col("n"))), F.lit(0).cast("long")).alias("null_trip"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0).cast("long")).alias("duplicate_keys"),
    )


# --- the same history operator on another table --------------------------------------

def _order_history(spark, sf_dir, profile=None):
    """Previous 30 orders of the same priority (by date, then key): count, mean
    and sample deviation of their total price.  Five priorities over all orders:
    every key is hot, which is what the chunked operator is for."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    price = unit_values("o_totalprice", 2, squares=True)  # prices are in cents
    present = F.when(F.col("o_orderkey").isNotNull(), F.lit(1)).otherwise(F.lit(0))
    out = history.trailing_sums(
        orders, ["o_orderpriority"], ["o_orderdate", "o_orderkey"], 30,
        {"prev_order_count": present, **{f"_p{k}": v for k, v in price.items()}},
        wide={f"_p{k}" for k in ("s", *SQUARE_PARTS)}, profile=profile)
    s, n, q = F.col("_ps"), F.col("_pn"), F.struct(*[F.col(f"_p{k}").alias(k) for k in SQUARE_PARTS])
    out = with_stddev(out, "prev_stddev_totalprice", s, q, n, 2)
    return out.select("o_orderkey", "o_orderpriority", "o_orderdate", "prev_order_count",
                      rounded_mean_of(s, n, 2, 2).alias("prev_avg_totalprice"),
                      F.round("prev_stddev_totalprice", 2).alias("prev_stddev_totalprice"))


@query
def priority_order_history(spark, sf_dir):
    return _order_history(spark, sf_dir)


@query
def priority_order_history_split(spark, sf_dir):
    """The same by the split-key plan, whatever the size of the keys."""
    return _order_history(spark, sf_dir, profile=(sys.maxsize, read_table(spark, sf_dir, "orders").count()))


# --- CSV sources: batch (header-aware) and incremental stream -------------------------

def _halves(df: DataFrame, column: str):
    even = F.coalesce((F.col(column) % 2) == 0, F.lit(True))
    return df.filter(even), df.filter(~even)


@query
def csv_batch_ingest(spark, sf_dir):
    """Telemetry written as CSV in two header layouts (one reversed, with an extra
    column), read back aligned by name and cleaned: equals ``clean_signals``."""
    raw = telemetry(spark, sf_dir)
    root = scratch_path(spark, "csv-batch")
    a, b = _halves(raw, "VehId")
    write_csv(a, f"{root}/layout_a")
    reordered = [F.col(f"`{c}`") for c in reversed(RAW_COLUMNS)] + [F.lit("1").alias("Extra Signal")]
    write_csv(b.select(*reordered), f"{root}/layout_b")
    return clean_telemetry(read_telemetry_csv(spark, root))


@query
def csv_stream_ingest(spark, sf_dir):
    """Telemetry CSV arriving in two drops, ingested by two triggered stream runs
    (a third run finds nothing new), then cleaned: equals ``clean_signals``."""
    raw = telemetry(spark, sf_dir)
    root = scratch_path(spark, "csv-stream")
    source, sink, checkpoint = f"{root}/source", f"{root}/sink", f"{root}/checkpoint"
    first, second = _halves(raw, "Trip")
    write_csv(first, f"{source}/drop1")
    run_ingest(spark, source, sink, checkpoint, transform=typed_samples)
    write_csv(second, f"{source}/drop2")
    run_ingest(spark, source, sink, checkpoint, transform=typed_samples)
    if run_ingest(spark, source, sink, checkpoint, transform=typed_samples) != 0:
        raise RuntimeError("stream re-run ingested rows twice")
    return clean_telemetry(spark.read.parquet(sink))


@query
def csv_float_ids(spark, sf_dir):
    """Telemetry CSV whose ids and times are written as ``8.0`` or ``1.0E7``: equals ``clean_signals``."""
    whole = [F.col(f"`{c}`").cast("double").alias(c) if c in ("VehId", "Trip", "Timestamp(ms)") else F.col(f"`{c}`")
             for c in RAW_COLUMNS]
    root = scratch_path(spark, "csv-float-ids")
    write_csv(telemetry(spark, sf_dir).select(*whole), root)
    return clean_telemetry(read_telemetry_csv(spark, root))


@query
def csv_wide_header(spark, sf_dir):
    """Telemetry CSV behind a header line of over 64 KiB: equals ``clean_signals``."""
    extra = [F.lit(None).cast("string").alias(f"a source column that carries no signal of this library, number {i:05d}")
             for i in range(1000)]
    root = scratch_path(spark, "csv-wide")
    write_csv(telemetry(spark, sf_dir).select(*extra, *[F.col(f"`{c}`") for c in RAW_COLUMNS]), root)
    return clean_telemetry(read_telemetry_csv(spark, root))


@query
def csv_stream_evolution(spark, sf_dir):
    """One backlog of old files and of files with reversed columns and an added one,
    ingested by one stream run; the added column is NULL for the old files."""
    root = scratch_path(spark, "csv-evolution")
    source, sink = f"{root}/source", f"{root}/sink"
    old, new = _halves(telemetry(spark, sf_dir), "Trip")
    write_csv(old, f"{source}/old")
    write_csv(new.select(*[F.col(f"`{c}`") for c in reversed(RAW_COLUMNS)],
                         F.col("Trip").cast("long").cast("string").alias("new_col")), f"{source}/new")
    run_ingest(spark, source, sink, f"{root}/checkpoint", transform=typed_samples)
    return clean_telemetry(spark.read.option("mergeSchema", True).parquet(sink), keep_extra=True) \
        .drop("ingestion_timestamp", "ingest_batch")


@query
def csv_schema_log(spark, sf_dir):
    """Two drops ingested by two stream runs that share a schema log: the second one adds a
    column and holds fractions where the first had whole numbers.  Read back by the log,
    with the number of its versions."""
    root = scratch_path(spark, "csv-schema-log")
    old, new = _halves(telemetry(spark, sf_dir), "Trip")
    trip = F.col("Trip").cast("long")
    run = lambda: run_ingest(spark, f"{root}/source", table_path(root, "bronze_ev_telemetry"), f"{root}/checkpoint",
                             transform=typed_samples, schema_dir=schema_log_path(root, "bronze_ev_telemetry"))
    write_csv(old.withColumn("aux", trip), f"{root}/source/old")
    run()
    write_csv(new.select(F.concat(F.lit("v"), trip).alias("added"), "*", (trip + F.lit(0.5)).alias("aux")), f"{root}/source/new")
    run()
    versions = SchemaLog(schema_log_path(root, "bronze_ev_telemetry")).versions()
    return read_table_of(spark, root, "bronze_ev_telemetry") \
        .drop("ingestion_timestamp", "ingest_batch", RESCUED).withColumn("schema_versions", F.lit(len(versions)))


def _with_broken_text(raw: DataFrame) -> DataFrame:
    """Telemetry in which some values of three columns are no numbers (and NaN stays NaN)."""
    ms, trip = F.col("Timestamp(ms)").cast("long"), F.col("Trip").cast("long")
    broken = {"VehId": (ms % 97 == 0, F.concat(F.col("VehId").cast("long"), F.lit(".5"))),
              "Energy_Consumption": (ms % 89 == 0, F.lit("n/a")),
              "Latitude[deg]": (trip % 50 == 7, F.lit("42,22"))}
    return raw.select(*[F.when(broken[c][0], broken[c][1]).otherwise(F.col(f"`{c}`").cast("string")).alias(c)
                        if c in broken else F.col(f"`{c}`") for c in RAW_COLUMNS])


@query
def csv_rescued_values(spark, sf_dir):
    """Values that failed their type in a stream of broken files, by source column, and samples without a key."""
    root = scratch_path(spark, "csv-rescue")
    write_csv(_with_broken_text(telemetry(spark, sf_dir)), f"{root}/source")
    run_ingest(spark, f"{root}/source", f"{root}/sink", f"{root}/checkpoint", transform=typed_samples)
    return rescued_counts(spark.read.parquet(f"{root}/sink"))


@query
def csv_rescued_samples(spark, sf_dir):
    """The samples of the same files, with the text that failed its type."""
    root = scratch_path(spark, "csv-rescue")
    write_csv(_with_broken_text(telemetry(spark, sf_dir)), root)
    return clean_telemetry(read_telemetry_csv(spark, root), rescue=True)


@query
def ingestion_time(spark, sf_dir):
    """Rows by ingestion time of a stream run under a fixed clock."""
    root = scratch_path(spark, "csv-clock")
    write_csv(telemetry(spark, sf_dir), f"{root}/source")
    run_ingest(spark, f"{root}/source", f"{root}/sink", f"{root}/checkpoint", transform=typed_samples,
               now=F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return (spark.read.parquet(f"{root}/sink")
            .groupBy(F.date_format("ingestion_timestamp", "yyyy-MM-dd HH:mm:ss").alias("ingested_at"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


@query
def silver_table_round_trip(spark, sf_dir):
    """Silver written as a clustered, partitioned table and read back with its
    descriptor's keys, under a fixed processing time: equals ``silver_trips``."""
    root = scratch_path(spark, "tables")
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    write_table(build_trips(samples(spark, sf_dir), now=now), root, "silver_ev_trips")
    keys = describe_table(root, "silver_ev_trips")["keys"]
    out = read_table_of(spark, root, "silver_ev_trips")
    return out.withColumn("processed_at", F.date_format("processing_timestamp", "yyyy-MM-dd HH:mm:ss")) \
        .drop("processing_timestamp").withColumn("table_keys", F.lit(",".join(keys)))


# --- row checks on output tables (counts and a keyed preview) ---------------------

@query
def table_row_counts(spark, sf_dir):
    """Row count of every output table, computed from one written silver table."""
    trips = written_silver(spark, sf_dir)
    tables = {
        "silver_ev_trips": trips,
        "gold_vehicle_daily_stats": aggregates.vehicle_daily_stats(trips),
        "gold_route_patterns": aggregates.route_patterns(trips),
        "gold_temporal_patterns": aggregates.temporal_patterns(trips),
        "ml_features_energy_prediction": features.build_features(trips, trips_written=True),
    }
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
              for name, df in tables.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@query
def silver_preview(spark, sf_dir):
    """First ten trips by (VehId, DayNum, Trip): a top-k, each task keeps ten."""
    cols = [c for c in SILVER_COLUMNS if c != "processing_timestamp"]
    return silver(spark, sf_dir).orderBy("VehId", "DayNum", "Trip").limit(10).select(*cols)
