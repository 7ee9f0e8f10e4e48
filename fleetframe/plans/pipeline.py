"""End-to-end run: CSV files -> bronze -> silver -> gold -> ML features.

Every layer is written once and read back by the next, so the three gold
tables and the feature table share one silver computation, and a lost
executor recomputes from the last written layer, not from the raw files.

Refreshes are incremental where the data allows it:

* bronze is partitioned by the number of the ingestion batch;
* vehicle signal flags are a ``max`` per vehicle, so old flags merged with
  the flags of the new rows equal the flags over all rows;
* when the set of battery-electric vehicles is unchanged, only trips on the
  days that received new samples can change: those days' samples are read
  (a ``DayNum`` range filter reaches the bronze scan), their trips rebuilt and
  written over just those ``trip_date`` partitions of silver; daily stats
  follow the same days;
* when the set changes (a vehicle shows a combustion signal, or a new
  battery-only vehicle appears), silver is rebuilt in full;
* sums and vehicle bitmaps per day are kept for routes and hours of the week
  (``route_day_parts``, ``temporal_day_parts``); the touched days' are replaced, and
  the patterns put together from them, so no trip of another day is read;
* trip history is kept per trip (``trip_history``) and computed again where the
  touched days can have changed it (``operators.refresh``); the features, whose
  every row holds the fleet mean, are written from it in one pass;
* a run without new data leaves every table as it is.

A run that fails is repeated from the state of the last completed one.  The last
batch is read from bronze itself; a rebuild in full is put down in the state before
the first table changes, so a repeated run cannot mistake the new vehicle list for
the old one; a day refresh writes the same days again.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from fleetframe.functions.calendar import DAYNUM_EPOCH
from fleetframe.operators.aggregates import (
    route_day_parts, route_patterns_from_parts, temporal_day_parts, temporal_patterns_from_parts, values_out_of_range,
    vehicle_daily_stats,
)
from fleetframe.operators.cleaning import RESCUED, clean_telemetry, rescued_counts
from fleetframe.operators.features import features_from_history, history_stage
from fleetframe.operators.quality import (
    SILVER_RULES, STRICT_RULES, expect_or_drop, rule_metrics,
)
from fleetframe.operators.refresh import refreshed_history
from fleetframe.operators.trips import ev_trip_aggregates, trip_measures
from fleetframe.operators.vehicles import vehicle_signals
from fleetframe.plans.catalog import TABLES, read_table, restore_tables, schema_log_path, table_path, write_descriptor, write_table
from fleetframe.plans.compact import batch_numbers, compact_bronze, resume_compaction
from fleetframe.schema import BEV_LABEL, SAMPLE_COLUMNS, SAMPLE_TYPES, TRIP_KEYS
from fleetframe.session import materialize, run_folder, scratch_path
from fleetframe.sources.files import path_exists, read_text, remove_dir, write_text
from fleetframe.streaming.ingest import BATCH_COLUMN, run_ingest, typed_samples


@dataclass
class PipelineConfig:
    source_path: str             # folder the telemetry CSV files arrive in
    root: str                    # output root: <root>/<layer>/<table>
    now: str | None = None       # fixed processing time (ISO text) for reproducible runs
    strict: bool = False         # also drop zero-distance / zero-energy / keyless trips
    chunks: int | None = None    # range chunks of the history windows
    # a large backlog is ingested as several committed batches, not one
    max_files_per_trigger: int | None = 1000
    compact_batches: int = 32    # once bronze has more batch folders, the older ones are rewritten as one
    keep_intermediate: bool = False  # keep this run's intermediate files (debugging)
    full_refresh: bool = False   # rebuild silver from all of bronze
    results: dict = field(default_factory=dict)

    def clock(self) -> Column | None:
        return F.lit(self.now).cast("timestamp") if self.now else None

    @property
    def checkpoint(self) -> str:
        return f"{self.root.rstrip('/')}/_checkpoints"

    @property
    def state_path(self) -> str:
        return f"{self.root.rstrip('/')}/_state/pipeline.json"

    @property
    def rules(self):
        return STRICT_RULES if self.strict else SILVER_RULES


def load_state(cfg: PipelineConfig) -> dict:
    return json.loads(read_text(cfg.state_path)) if path_exists(cfg.state_path) else {}


def save_state(cfg: PipelineConfig, state: dict) -> None:
    write_text(cfg.state_path, json.dumps(state, indent=1))


def ingest_bronze(spark: SparkSession, cfg: PipelineConfig) -> int:
    if not path_exists(cfg.source_path):
        raise FileNotFoundError(f"source folder {cfg.source_path} does not exist")
    bronze = table_path(cfg.root, "bronze_ev_telemetry")
    rows = run_ingest(spark, cfg.source_path, bronze, f"{cfg.checkpoint}/bronze_ev_telemetry", now=cfg.clock(),
                      transform=typed_samples, max_files_per_trigger=cfg.max_files_per_trigger,
                      schema_dir=schema_log_path(cfg.root, "bronze_ev_telemetry"))
    if rows:
        write_descriptor(bronze, TABLES["bronze_ev_telemetry"])
    return rows


def ingest_report(spark: SparkSession, cfg: PipelineConfig, before: int | None) -> dict:
    """What the batches after number ``before`` held beside clean samples: values per source
    column whose text failed its type, and (``_no_key``) samples without a trip key."""
    schema = T.StructType([T.StructField(c, SAMPLE_TYPES[c]) for c in TRIP_KEYS])
    new = spark.read.schema(schema.add(RESCUED, T.StringType()).add(BATCH_COLUMN, T.LongType())).parquet(
        table_path(cfg.root, "bronze_ev_telemetry")).where(F.col(BATCH_COLUMN) > F.lit(-1 if before is None else before))
    return {r["column_name"]: r["n_values"] for r in rescued_counts(new).collect()}  # a row for each source column


def latest_batch(cfg: PipelineConfig) -> int | None:
    """Number of the last batch in bronze, from its folder names."""
    return max(batch_numbers(cfg.root), default=None)


def bronze_samples(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """The canonical columns of bronze and the batch number; the schema is known, so no
    file is opened to find it."""
    schema = T.StructType([T.StructField(c, SAMPLE_TYPES[c]) for c in SAMPLE_COLUMNS])
    return spark.read.schema(schema.add(BATCH_COLUMN, T.LongType())).parquet(
        table_path(cfg.root, "bronze_ev_telemetry"))


def _ev_from_flags(flags: DataFrame) -> DataFrame:
    return (flags.filter((F.col("has_battery") == 1) & (F.col("has_combustion") == 0))
            .select("VehId", F.lit(BEV_LABEL).alias("vehicle_type")))


def _same_vehicles(a: DataFrame, b: DataFrame) -> bool:
    ka, kb = a.select("VehId"), b.select("VehId")
    return ka.exceptAll(kb).isEmpty() and kb.exceptAll(ka).isEmpty()


def refresh_vehicles(spark: SparkSession, cfg: PipelineConfig, state: dict, bronze: DataFrame,
                     new_rows: DataFrame | None) -> bool:
    """Write vehicle flags and the EV list; True if the EV set changed (put down in
    the state before either table is replaced)."""
    if new_rows is None:
        flags = vehicle_signals(clean_telemetry(bronze))
        old_ev = None
    else:
        merged = read_table(spark, cfg.root, "vehicle_signals").unionByName(
            vehicle_signals(clean_telemetry(new_rows)))
        flags = merged.groupBy("VehId").agg(F.max("has_combustion").alias("has_combustion"),
                                            F.max("has_battery").alias("has_battery"))
        old_ev = read_table(spark, cfg.root, "ev_vehicles")
    flags = materialize(flags, "vehicle-flags")  # read before the tables are replaced
    changed = old_ev is None or not _same_vehicles(old_ev, _ev_from_flags(flags))
    if changed:
        state["rebuild"] = True
        save_state(cfg, state)
    write_table(flags, cfg.root, "vehicle_signals")
    write_table(_ev_from_flags(flags), cfg.root, "ev_vehicles")
    return changed


def _trip_candidates(spark: SparkSession, cfg: PipelineConfig, samples: DataFrame) -> DataFrame:
    vehicles = read_table(spark, cfg.root, "ev_vehicles")
    # written once: the rule counts and the clustered write (whose range
    # sampling would otherwise re-run the trip aggregation) read them
    return materialize(
        trip_measures(ev_trip_aggregates(samples, vehicles, vehicles_written=True), cfg.clock()),
        "silver-candidates")


def _rule_counts(candidates: DataFrame, rules) -> dict:
    counts = rule_metrics(candidates, rules).collect()  # one row per rule
    out = {"rows_in": counts[0]["rows_checked"] if counts else 0}
    out.update({f"failed_{r['rule']}": r["rows_failed"] for r in counts})
    beyond = {r["measure"]: r["n_values"] for r in values_out_of_range(candidates).collect()}  # a row for each measure
    return {**out, **({"values_out_of_range": beyond} if beyond else {})}


def _affected_days(spark: SparkSession, cfg: PipelineConfig, new_rows: DataFrame) -> list[int] | None:
    """Day numbers (floor of DayNum) of new samples of EV vehicles (a few per run);
    None when some have no DayNum (their trip has no date partition to refresh)."""
    ev = read_table(spark, cfg.root, "ev_vehicles").select("VehId")
    days = (clean_telemetry(new_rows).join(ev, "VehId", "left_semi")
            .select(F.floor("DayNum").alias("d")).distinct().collect())
    if any(r["d"] is None for r in days):
        return None
    return sorted(int(r["d"]) for r in days)


def samples_on_days(bronze: DataFrame, days: list[int]) -> DataFrame:
    """Clean samples whose day number is in ``days``.  The range test runs on the
    stored column, before cleaning, so it reaches the Parquet scan (row groups
    outside the range are skipped); the exact day test follows."""
    in_range = (F.col("DayNum") >= float(days[0])) & (F.col("DayNum") < float(days[-1] + 1))
    return clean_telemetry(bronze.filter(in_range)).filter(F.floor("DayNum").isin(days))


def _dates(days: list[int]) -> list:
    import datetime as dt
    epoch = dt.date.fromisoformat(DAYNUM_EPOCH)
    return [epoch + dt.timedelta(days=d) for d in days]


def _drop_emptied_partitions(spark: SparkSession, cfg: PipelineConfig, name: str,
                             written: DataFrame, dates: list) -> None:
    """Affected dates that produced no rows keep their old folder under dynamic
    overwrite; remove those folders."""
    present = {r["trip_date"] for r in written.select("trip_date").distinct().collect()}
    for d in dates:
        if d not in present:
            remove_dir(f"{table_path(cfg.root, name)}/trip_date={d.isoformat()}")


def build_silver(spark: SparkSession, cfg: PipelineConfig, state: dict) -> dict:
    bronze = bronze_samples(spark, cfg)
    through = state.get("silver_through_batch")
    kept = ("vehicle_signals", "ev_vehicles", "silver_ev_trips", "gold_vehicle_daily_stats", "route_day_parts",
            "temporal_day_parts", "trip_history")
    incremental = (through is not None and not cfg.full_refresh and not state.get("rebuild")
                   and state.get("strict") == cfg.strict
                   and all(path_exists(table_path(cfg.root, name)) for name in kept))
    new_rows = bronze.filter(F.col(BATCH_COLUMN) > F.lit(int(through))) if incremental else None
    if refresh_vehicles(spark, cfg, state, bronze, new_rows):
        incremental = False
    samples = clean_telemetry(bronze)
    days = _affected_days(spark, cfg, new_rows) if incremental else None
    if days is None:
        incremental = False
    if not incremental:
        candidates = _trip_candidates(spark, cfg, samples)
        write_table(expect_or_drop(candidates, cfg.rules), cfg.root, "silver_ev_trips")
        report = {"mode": "full", **_rule_counts(candidates, cfg.rules)}
        days = None
    else:
        report = {"mode": "incremental", "days": len(days), "rows_in": 0}
        if days:
            candidates = _trip_candidates(spark, cfg, samples_on_days(bronze, days))
            kept = expect_or_drop(candidates, cfg.rules)
            write_table(kept, cfg.root, "silver_ev_trips", only_touched_partitions=True)
            _drop_emptied_partitions(spark, cfg, "silver_ev_trips", kept, _dates(days))
            report.update(_rule_counts(candidates, cfg.rules))
    state["silver_days_refreshed"] = days
    return report


def _refresh_days(spark: SparkSession, cfg: PipelineConfig, name: str, rows: DataFrame, dates: list) -> None:
    """Replace the partitions of ``dates`` in a table by ``rows`` (those without rows go)."""
    rows = materialize(rows, f"{name}-refresh")
    write_table(rows, cfg.root, name, only_touched_partitions=True)
    _drop_emptied_partitions(spark, cfg, name, rows, dates)


def build_gold(spark: SparkSession, cfg: PipelineConfig, state: dict) -> None:
    """Daily stats and the stored sums per day: all days, or those silver has replaced.
    Route and hour-of-week patterns are put together from the sums."""
    silver = read_table(spark, cfg.root, "silver_ev_trips")
    days = state.get("silver_days_refreshed")
    per_day = {"gold_vehicle_daily_stats": lambda trips: vehicle_daily_stats(trips, cfg.clock()),
               "route_day_parts": route_day_parts, "temporal_day_parts": temporal_day_parts}
    dates = None if days is None else _dates(days)
    touched = silver if days is None else silver.filter(F.col("trip_date").isin(dates))
    for name, build in per_day.items():
        if days is None:  # written first: a clustered write runs its input twice, once to sample ranges
            write_table(materialize(build(touched), name), cfg.root, name)
        elif days:
            _refresh_days(spark, cfg, name, build(touched), dates)
    if days is None or days:
        write_table(route_patterns_from_parts(read_table(spark, cfg.root, "route_day_parts"), now=cfg.clock()),
                    cfg.root, "gold_route_patterns")
        write_table(temporal_patterns_from_parts(read_table(spark, cfg.root, "temporal_day_parts"), cfg.clock()),
                    cfg.root, "gold_temporal_patterns")


def build_ml_features(spark: SparkSession, cfg: PipelineConfig, state: dict) -> None:
    """Trip history: all trips, or those that the replaced days can have touched; then the
    feature table (every row holds the fleet mean) from the written history."""
    silver = read_table(spark, cfg.root, "silver_ev_trips")
    days = state.get("silver_days_refreshed")
    if state.get("history_pending"):
        days = None  # a refresh died among its partitions
    if days:
        state["history_pending"] = True
        save_state(cfg, state)
    if days is None:
        write_table(materialize(history_stage(silver, cfg.chunks), "history"), cfg.root, "trip_history")
    elif days:
        rows, touched = refreshed_history(
            silver, read_table(spark, cfg.root, "trip_history"), read_table(spark, cfg.root, "gold_vehicle_daily_stats"),
            read_table(spark, cfg.root, "route_day_parts"), _dates(days), cfg.chunks)
        _refresh_days(spark, cfg, "trip_history", rows, touched)
    if days is None or days:
        write_table(features_from_history(read_table(spark, cfg.root, "trip_history"), cfg.clock()),
                    cfg.root, "ml_features_energy_prediction")  # published only if its constraints hold


def run(spark: SparkSession, cfg: PipelineConfig) -> dict:
    """Ingest new files and refresh every layer; returns row counts and rule counts.

    Intermediate results of this run go to one folder under the checkpoint
    root, removed once every table is written (kept if the run fails)."""
    run_dir = scratch_path(spark, "pipeline-run")
    state = load_state(cfg)
    with run_folder(run_dir):
        restore_tables(cfg.root)
        resume_compaction(cfg.root)
        before = latest_batch(cfg)
        cfg.results["bronze_rows_ingested"] = ingest_bronze(spark, cfg)
        latest = latest_batch(cfg)
        if cfg.results["bronze_rows_ingested"]:
            cfg.results["rescued"] = ingest_report(spark, cfg, before)
        if latest is None:
            return cfg.results  # nothing ingested yet
        if (state.get("silver_through_batch") == latest and state.get("strict") == cfg.strict
                and not state.get("rebuild") and not cfg.full_refresh):
            # the last run finished every layer (the marker is saved last): all current
            cfg.results["silver_quality"] = {"mode": "unchanged"}
        else:
            cfg.results["silver_quality"] = build_silver(spark, cfg, state)
            build_gold(spark, cfg, state)
            build_ml_features(spark, cfg, state)
            state.update(silver_through_batch=latest, strict=cfg.strict)
            state.pop("silver_days_refreshed", None)
            state.pop("rebuild", None)
            state.pop("history_pending", None)
            save_state(cfg, state)
        if len(batch_numbers(cfg.root)) > cfg.compact_batches:
            cfg.results["bronze_batches_compacted"] = compact_bronze(spark, cfg.root)
    if not cfg.keep_intermediate:
        remove_dir(run_dir)
    return cfg.results
