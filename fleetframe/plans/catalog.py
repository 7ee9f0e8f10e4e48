"""Table registry: layer, description, keys, partitioning and clustering of every table.

Tables live at ``<root>/<layer>/<name>`` as Parquet.  ``partition_by``
columns become folders (a refresh rewrites only the partitions it touched:
dynamic partition overwrite).  ``cluster_by`` columns are range-partitioned
and sorted on write, so Parquet min/max statistics let later reads skip files
and row groups for vehicle/day lookups; range partitioning also splits a
partition value that holds a large share of the rows over several tasks.

A sort serves lookups by its first column only.  ``interleaved`` tables are ordered
by the interleaved bits of each cluster column's range (``operators.clustering``): a row group
then spans a narrow range of every one of them.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

from fleetframe.operators.clustering import clustered
from fleetframe.operators.quality import FEATURE_KEY_RULES, Rule, require
from fleetframe.schema import DAILY_COLUMNS, ROUTE_KEYS, SAMPLE_TYPES, SILVER_COLUMNS
from fleetframe.sources.files import read_text, replace_dir, restore_dir, write_text
from fleetframe.sources.schema_log import SchemaLog, log_exists, read_logged


@dataclass(frozen=True)
class TableSpec:
    name: str
    layer: str
    comment: str
    keys: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    columns: tuple[str, ...] = ()  # column order on read (partition columns come last on disk)
    interleaved: bool = False  # cluster on all columns alike, not on the first one first
    constraints: tuple[Rule, ...] = ()  # every row holds them, or the table is not published
    unique: bool = False  # no two rows share the keys
    evolving: bool = False  # files may differ in columns: read by the table's schema log


TABLES = {t.name: t for t in (
    TableSpec("bronze_ev_telemetry", "bronze",
              "Telemetry samples as ingested from CSV files: signals typed and renamed, text that failed "
              "its type, other source columns as text, plus ingestion time and batch number.",
              (), ("VehId", "DayNum"), ("ingest_batch",), interleaved=True, evolving=True),
    TableSpec("vehicle_signals", "silver",
              "Per vehicle: whether any sample ever carried a combustion / battery signal.", ("VehId",)),
    TableSpec("ev_vehicles", "silver",
              "Vehicles with a battery signal and never a combustion signal.", ("VehId",)),
    TableSpec("silver_ev_trips", "silver",
              "One row per trip of a battery-electric vehicle with its measures.",
              ("DayNum", "VehId", "Trip"), ("trip_date", "VehId", "DayNum"), ("trip_date",),
              tuple(SILVER_COLUMNS)),
    TableSpec("gold_vehicle_daily_stats", "gold",
              "Trips, distance, energy and efficiency per vehicle and day.",
              ("VehId", "trip_date"), ("trip_date", "VehId"), ("trip_date",), tuple(DAILY_COLUMNS)),
    TableSpec("gold_route_patterns", "gold",
              "Energy and efficiency per rounded origin/destination route (>= 3 trips).",
              ("origin_lat_rounded", "origin_lon_rounded", "dest_lat_rounded", "dest_lon_rounded")),
    TableSpec("gold_temporal_patterns", "gold",
              "Energy and efficiency per day of week and hour.", ("trip_dayofweek", "trip_hour")),
    TableSpec("route_day_parts", "parts",
              "Sums and vehicle bitmaps per day and route, from which the route patterns are put together.",
              ("trip_date", *ROUTE_KEYS, "vehicle_bucket"), ("trip_date", *ROUTE_KEYS), ("trip_date",)),
    TableSpec("temporal_day_parts", "parts",
              "Sums per day and hour, from which the hour-of-week patterns are put together.",
              ("trip_date", "trip_dayofweek", "trip_hour"), ("trip_date", "trip_hour"), ("trip_date",)),
    TableSpec("trip_history", "parts",
              "One row per trip: its measures, vehicle and route history and engineered columns.",
              ("DayNum", "VehId", "Trip"), ("trip_date", "VehId", "DayNum"), ("trip_date",)),
    TableSpec("ml_features_energy_prediction", "ml_features",
              "Point-in-time features per trip for energy prediction (trips with history).",
              ("DayNum", "VehId", "Trip"), ("VehId", "trip_date"), interleaved=True,
              constraints=FEATURE_KEY_RULES, unique=True),
)}

# Column descriptions kept in the written schema (field metadata "comment").
COLUMN_COMMENTS = {
    "DayNum": "fractional day: integer part counts days from 2017-11-01 (day 1), fraction is time of day",
    "VehId": "vehicle id",
    "Trip": "trip number of the vehicle",
    "trip_date": "calendar date of the trip start",
    "start_timestamp_ms": "first sample time, ms (relative clock of the source)",
    "end_timestamp_ms": "last sample time, ms (relative clock of the source)",
    "distance_km": "great-circle distance first fix to last fix, km (2 decimals)",
    "duration_seconds": "last minus first sample time, seconds",
    "duration_minutes": "duration in minutes (2 decimals)",
    "total_energy_consumption": "sum of sample energy (2 decimals)",
    "efficiency_km_per_energy": "distance per unit of energy (4 decimals); NULL for zero energy",
    "elevation_gain_m": "max minus min elevation, m (2 decimals)",
    "trip_count": "samples in the trip",
    "target_energy_consumption": "prediction target: the trip's total energy",
    "vehicle_trip_count_last30": "trips of the vehicle among the previous 30 (by day, trip)",
    "route_trip_count": "trips on the route among the previous 10 (by day, vehicle, trip)",
    "vehicle_efficiency_vs_fleet": "own 30-trip efficiency minus the fleet mean of that column",
    "unique_vehicles": "distinct vehicles on the route",
}


def with_comments(df: DataFrame) -> DataFrame:
    known = {c: COLUMN_COMMENTS[c] for c in df.columns if c in COLUMN_COMMENTS}
    for column, comment in known.items():
        df = df.withMetadata(column, {"comment": comment})
    return df


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{TABLES[name].layer}/{name}"


def write_table(df: DataFrame, root: str, name: str, only_touched_partitions: bool = False) -> str:
    """Write a table.  Default: replace it, by a finished folder moved into its place.
    ``only_touched_partitions``: replace just the partitions present in ``df``
    (dynamic partition overwrite).  Declared constraints are checked on the finished
    folder (on ``df``, which should then be written data, for touched partitions) before
    anything is published: if one fails, ``ConstraintError`` is raised and the table
    stays as it was; the rejected folder stays under ``_staging``.
    Clustered tables are range-partitioned and sorted first (adaptive execution
    sizes the output partitions)."""
    spec, path = TABLES[name], table_path(root, name)
    out = with_comments(df)
    if spec.interleaved:
        out = clustered(out, spec.cluster_by)
    elif spec.cluster_by:
        out = out.repartitionByRange(*spec.cluster_by).sortWithinPartitions(*spec.cluster_by)
    checks = (spec.constraints, spec.keys if spec.unique else ())
    if only_touched_partitions and any(checks):
        require(df, *checks)
    target = path if only_touched_partitions else f"{root.rstrip('/')}/_staging/{name}-{uuid.uuid4().hex[:12]}"
    writer = out.write.mode("overwrite")
    if spec.partition_by:
        writer = (writer.partitionBy(*spec.partition_by)
                  .option("partitionOverwriteMode", "dynamic" if only_touched_partitions else "static"))
    writer.parquet(target)
    write_descriptor(target, spec)
    if target != path:
        if any(checks):
            require(df.sparkSession.read.parquet(target), *checks)
        replace_dir(target, path)
    return path


def write_descriptor(path: str, spec: TableSpec) -> None:
    write_text(f"{path}/_table.json", json.dumps(
        {"name": spec.name, "layer": spec.layer, "comment": spec.comment,
         "keys": list(spec.keys), "cluster_by": list(spec.cluster_by), "interleaved": spec.interleaved,
         "partition_by": list(spec.partition_by),
         "constraints": {r.name: r.condition for r in spec.constraints}, "unique": spec.unique}, indent=1))


def schema_log_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/_schemas/{name}"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table with its declared columns.  An evolving one has the columns and types of
    its schema log (of its merged files where it has none)."""
    spec, path = TABLES[name], table_path(root, name)
    if spec.evolving and log_exists(schema_log_path(root, name)):
        stored = {**SAMPLE_TYPES, "ingestion_timestamp": T.TimestampType()}
        return read_logged(spark, path, SchemaLog(schema_log_path(root, name)), stored,
                           (spec.partition_by[0], T.LongType()))
    df = spark.read.option("mergeSchema", spec.evolving).parquet(path)
    return df.select(*spec.columns) if spec.columns else df


def restore_tables(root: str) -> list[str]:
    """Bring back tables whose replacement a crash broke off; their names."""
    return [name for name in TABLES if restore_dir(table_path(root, name))]


def describe_table(root: str, name: str) -> dict:
    """The descriptor written next to a table."""
    return json.loads(read_text(f"{table_path(root, name)}/_table.json"))
