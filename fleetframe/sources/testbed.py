"""Telemetry-shaped samples derived from the ``events`` table.

The driver's test data has no vehicle telemetry, so this view maps each
event to one sample (FIXTURES.md section 3).  All arithmetic is exact or
evaluated in the same order as the DuckDB oracle, and time-zone free.

Vehicle classes by construction: ``user_id % 5 == 0`` combustion (hybrid),
``== 1`` no signal at all, others battery-electric.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed values of the view (FIXTURES.md section 3).
DAY_ZERO = "2023-12-31"
MS_PER_DAY = 86_400_000
NAN_TEXT = "NaN"


def _text(x) -> F.Column:
    return x.cast("string")


def telemetry_from_events(events: DataFrame) -> DataFrame:
    """Raw telemetry (CSV header names; signal columns as text) from ``events``."""
    eid, uid = F.col("event_id"), F.col("user_id")
    day = F.datediff(F.col("ts").cast("date"), F.lit(DAY_ZERO).cast("date"))
    millis = F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    hybrid = (uid % 5) == 0
    silent = (uid % 5) == 1
    nan = F.lit(NAN_TEXT)
    return events.select(
        (day + ((uid * 7 + day * 5) % 64) / 64).alias("DayNum"),
        uid.alias("VehId"),
        day.cast("long").alias("Trip"),
        (millis % MS_PER_DAY).alias("Timestamp(ms)"),
        (F.lit(42.22) + (eid % 4) * F.lit(0.01) + (eid % 5) * F.lit(0.001)).alias("Latitude[deg]"),
        (F.lit(-83.75) + (eid % 3) * F.lit(0.01)).alias("Longitude[deg]"),
        ((eid * 13) % 121).cast("double").alias("Vehicle Speed[km/h]"),
        F.when(F.col("event_type") == "error", nan)
         .when((uid % 10) == 4, F.lit("0.0"))
         .otherwise(_text(F.col("value"))).alias("Energy_Consumption"),
        F.when(hybrid, F.lit("1.5")).otherwise(nan).alias("Fuel Rate[L/hr]"),
        F.when(hybrid & ((eid % 2) == 0), F.lit("12.0")).otherwise(nan).alias("MAF[g/sec]"),
        F.when(hybrid, F.lit("1800")).otherwise(nan).alias("Engine RPM[RPM]"),
        F.when(silent | ((eid % 11) == 0), nan)
         .otherwise(_text(F.lit(20.0) + (eid % 320) * F.lit(0.25))).alias("HV Battery SOC[%]"),
        F.when(silent, nan).otherwise(_text((eid % 40) * F.lit(-0.25))).alias("HV Battery Current[A]"),
        F.when(silent, nan).otherwise(_text(F.lit(350.0) + (eid % 50) * F.lit(0.5))).alias("HV Battery Voltage[V]"),
        (F.lit(200.0) + (eid % 37)).alias("Elevation Smoothed[m]"),
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's test tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw telemetry derived from the ``events`` table of ``sf_dir``."""
    return telemetry_from_events(read_table(spark, sf_dir, "events"))
