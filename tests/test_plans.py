"""Plan shapes that matter at scale."""

from pyspark.sql import functions as F

from conftest import SF_TINY, rows_of
from fleetframe.operators.features import build_features
from fleetframe.operators.trips import build_trips
from fleetframe.plans.inspect import plan_text, rows_to_one_task
from fleetframe.plans.queries import REGISTRY, samples, silver


def test_semi_join_is_map_side_before_trip_shuffle(spark):
    text = plan_text(build_trips(samples(spark, SF_TINY)))
    assert "BroadcastHashJoin" in text and "LeftSemi" in text
    shuffle = text.index("Exchange hashpartitioning(DayNum")
    assert text.index("BroadcastHashJoin") > shuffle   # below the exchange: before the shuffle
    assert "SortMergeJoin" not in text


def test_scan_prunes_columns(spark):
    text = plan_text(build_trips(samples(spark, SF_TINY)), "formatted")
    schemas = [l for l in text.splitlines() if "ReadSchema" in l]
    assert schemas and all("props" not in s for s in schemas)


def test_features_never_funnel_rows_into_one_task(spark):
    spark.conf.set("fleetframe.history.maxKeyRows", "10")
    try:
        feats = build_features(silver(spark, SF_TINY), chunks=4)
        assert not rows_to_one_task(feats)
    finally:
        spark.conf.unset("fleetframe.history.maxKeyRows")


def test_history_window_is_split_by_chunk(spark):
    spark.conf.set("fleetframe.history.maxKeyRows", "10")   # every priority is "hot"
    try:
        df = REGISTRY["priority_order_history"](spark, SF_TINY)
        text = plan_text(df)
    finally:
        spark.conf.unset("fleetframe.history.maxKeyRows")
    window_lines = [l for l in text.splitlines() if "Window [" in l]
    data_windows = [l for l in window_lines if "collect_list" not in l]
    # the row windows are keyed by (priority, chunk); the only other window runs
    # over the per-(key, chunk) count table to plan the halo copies
    assert data_windows and all("_tw_target" in l for l in data_windows)
    assert len(window_lines) - len(data_windows) == 1
    assert not rows_to_one_task(df)


def test_filters_reach_parquet_scan(spark, tmp_dir):
    from fleetframe.plans.catalog import read_table, write_table
    write_table(silver(spark, SF_TINY), tmp_dir, "silver_ev_trips")
    q = read_table(spark, tmp_dir, "silver_ev_trips").filter(F.col("VehId") == 8).select("Trip", "distance_km")
    text = plan_text(q, "formatted")
    assert "PushedFilters: [IsNotNull(VehId), EqualTo(VehId,8)]" in text
    assert "ReadSchema: struct<VehId:bigint,Trip:bigint,distance_km:double>" in text


def test_every_aggregate_is_hash_based(spark):
    """No sort-based aggregation (it would sort every raw sample map-side)."""
    for name in ("silver_trips", "vehicle_daily_stats", "route_patterns", "temporal_patterns",
                 "vehicle_classes", "quality_metrics"):
        text = plan_text(REGISTRY[name](spark, SF_TINY))
        assert "SortAggregate" not in text and "HashAggregate" in text, name
        assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text, name


def test_incremental_day_filter_reaches_bronze_scan(spark, tmp_dir):
    from fleetframe.operators.cleaning import clean_telemetry
    from fleetframe.streaming.ingest import typed_samples
    from fleetframe.sources.testbed import telemetry
    from fleetframe.plans.pipeline import samples_on_days
    typed_samples(telemetry(spark, SF_TINY)).write.parquet(f"{tmp_dir}/bronze")
    bronze = spark.read.parquet(f"{tmp_dir}/bronze")
    q = samples_on_days(bronze, [3, 5])
    text = plan_text(q, "formatted")
    pushed = [l for l in text.splitlines() if "PushedFilters" in l]
    assert pushed and "GreaterThanOrEqual(DayNum,3.0)" in pushed[0] and "LessThan(DayNum,6.0)" in pushed[0]
    expected = clean_telemetry(bronze).filter(F.floor("DayNum").isin([3, 5]))
    assert q.count() == expected.count() > 0


def test_daily_refresh_prunes_silver_partitions(spark, tmp_dir):
    import datetime as dt
    from fleetframe.plans.catalog import read_table, write_table
    write_table(silver(spark, SF_TINY), tmp_dir, "silver_ev_trips")
    q = read_table(spark, tmp_dir, "silver_ev_trips").filter(F.col("trip_date").isin([dt.date(2017, 11, 3)]))
    text = plan_text(q, "formatted")
    assert any("PartitionFilters" in l and "trip_date" in l for l in text.splitlines())


def test_operators_run_in_whole_stage_codegen(spark):
    """After execution, every project, filter, aggregate and join of the final
    plan is inside whole-stage codegen (marked ``*``): no interpreted expression."""
    import re
    for name in ("silver_trips", "vehicle_daily_stats", "route_patterns", "feature_table"):
        df = REGISTRY[name](spark, SF_TINY)
        df.collect()
        final = plan_text(df, "formatted").split("== Initial Plan ==")[0]
        for line in final.splitlines():
            m = re.search(r"(\*\s)?(Project|Filter|HashAggregate|BroadcastHashJoin|SortMergeJoin) \(\d+\)", line)
            if m:
                assert m.group(1), (name, line.strip())


def test_long_vehicle_list_filters_samples_at_run_time(spark):
    """Beyond the broadcast budget, a Bloom filter of the list stands below the trip shuffle."""
    from fleetframe.operators.trips import build_trips
    from fleetframe.session import materialize
    data = materialize(samples(spark, SF_TINY), "bloom-samples")
    base = rows_of(build_trips(data).drop("processing_timestamp"))
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        df = build_trips(data)
        text = plan_text(df)
        assert "SortMergeJoin" in text and "might_contain" in text
        assert text.index("might_contain") > text.index("Exchange hashpartitioning(DayNum")
        assert rows_of(df.drop("processing_timestamp")) == base
    finally:
        for k in confs:
            spark.conf.unset(k)


def test_generated_code_compiles(spark):
    """No projection is too long to compile (Spark would then interpret it, row by row)."""
    from fleetframe.operators import aggregates
    from fleetframe.session import materialize
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        for name in ("feature_table", "priority_order_history", "vehicle_daily_stats", "csv_rescued_samples"):
            REGISTRY[name](spark, SF_TINY).collect()
        trips = materialize(silver(spark, SF_TINY), "compiled")
        aggregates.route_patterns_from_parts(materialize(aggregates.route_day_parts(trips), "compiled")).collect()
        aggregates.temporal_patterns_from_parts(materialize(aggregates.temporal_day_parts(trips), "compiled")).collect()
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
