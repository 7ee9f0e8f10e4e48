"""fleetframe: vehicle-telemetry trip analytics on Spark DataFrames.

Public API (all functions take and return DataFrames unless noted)::

    clean_telemetry(raw)                 raw CSV-shaped samples -> typed canonical samples
    read_telemetry_csv(spark, path)      header-aware batch read of CSV files
    run_ingest(spark, src, sink, ckpt)   one triggered streaming ingestion (returns rows)
    vehicle_signals(samples) / ev_vehicles(samples)
    build_trips(samples)                 the silver trip table (quality rules applied)
    vehicle_daily_stats / route_patterns / temporal_patterns (trips)
    build_features(trips)                the point-in-time feature table
    trailing_sums(df, keys, order, frame, values)             trailing sums/counts, one pass, skew-safe
    trailing_aggregates(df, keys, order, frame, aggregates)   any aggregate over a trailing frame, skew-safe
    PipelineConfig, run_pipeline(spark, cfg)                  layered end-to-end run
"""

__version__ = "0.1.0"

from fleetframe.operators.aggregates import route_patterns, temporal_patterns, vehicle_daily_stats
from fleetframe.operators.cleaning import clean_telemetry
from fleetframe.operators.features import build_features
from fleetframe.operators.history import trailing_aggregates, trailing_sums
from fleetframe.operators.quality import STRICT_RULES, SILVER_RULES, Rule, expect_or_drop, rule_metrics
from fleetframe.operators.trips import build_trips
from fleetframe.operators.vehicles import ev_vehicles, vehicle_signals
from fleetframe.plans.pipeline import PipelineConfig
from fleetframe.plans.pipeline import run as run_pipeline
from fleetframe.sources.csv import read_telemetry_csv
from fleetframe.streaming.ingest import run_ingest

__all__ = [
    "route_patterns", "temporal_patterns", "vehicle_daily_stats", "clean_telemetry",
    "build_features", "trailing_aggregates", "trailing_sums", "STRICT_RULES", "SILVER_RULES", "Rule",
    "expect_or_drop", "rule_metrics", "build_trips", "ev_vehicles", "vehicle_signals",
    "PipelineConfig", "run_pipeline", "read_telemetry_csv", "run_ingest",
]
