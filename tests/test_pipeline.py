"""End-to-end layered run from CSV files equals the registered queries."""

from conftest import rows_of
from fleetframe.plans.catalog import TABLES, read_table
from fleetframe.plans.pipeline import PipelineConfig, run
from fleetframe.plans.queries import REGISTRY
from fleetframe.sources.csv import write_csv
from fleetframe.sources.testbed import telemetry
from conftest import SF_TINY


def test_pipeline_layers(spark, tmp_dir):
    write_csv(telemetry(spark, SF_TINY), f"{tmp_dir}/incoming/batch1", partitions=3)
    cfg = PipelineConfig(source_path=f"{tmp_dir}/incoming", root=f"{tmp_dir}/lake",
                         now="2024-01-01 00:00:00", chunks=3)
    import glob
    from fleetframe.session import checkpoint_root, local_path
    scratch = local_path(checkpoint_root(spark)) + "/fleetframe"
    before = set(glob.glob(f"{scratch}/pipeline-run-*"))
    result = run(spark, cfg)
    assert result["bronze_rows_ingested"] == 1000
    assert set(glob.glob(f"{scratch}/pipeline-run-*")) == before   # intermediates removed
    q = result["silver_quality"]
    silver = read_table(spark, cfg.root, "silver_ev_trips")
    silver_rows = silver.count()
    assert q["rows_in"] - q["failed_valid_duration"] == silver_rows

    cols = [c for c in silver.columns if c != "processing_timestamp"]
    expected = REGISTRY["silver_trips"](spark, SF_TINY)
    assert rows_of(silver.select(*cols)) == rows_of(expected.select(*cols))

    feats = read_table(spark, cfg.root, "ml_features_energy_prediction")
    expected_f = REGISTRY["feature_table"](spark, SF_TINY)
    fcols = [c for c in feats.columns if c != "feature_timestamp"]
    assert rows_of(feats.select(*fcols)) == rows_of(expected_f.select(*fcols))
    from pyspark.sql import functions as F

    def rounded(df):  # the queries round unrounded float columns to 4 decimals for the oracle
        return df.select(*[F.round(c, 4).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])

    for table, query_name in (("gold_vehicle_daily_stats", "vehicle_daily_stats"),
                              ("gold_route_patterns", "route_patterns"),
                              ("gold_temporal_patterns", "temporal_patterns")):
        got = rounded(read_table(spark, cfg.root, table).drop("processing_timestamp"))
        expected_g = rounded(REGISTRY[query_name](spark, SF_TINY)).select(*got.columns)
        assert rows_of(got) == rows_of(expected_g), table
    for name in TABLES:
        assert read_table(spark, cfg.root, name).count() >= 0
    from fleetframe.plans.catalog import describe_table
    spec = describe_table(cfg.root, "silver_ev_trips")
    assert spec["cluster_by"] == ["trip_date", "VehId", "DayNum"] and spec["partition_by"] == ["trip_date"]
    field = read_table(spark, cfg.root, "silver_ev_trips").schema["distance_km"]
    assert "great-circle" in field.metadata["comment"]

    # a second run with no new files ingests nothing and leaves silver as it is
    again = run(spark, cfg)
    assert again["bronze_rows_ingested"] == 0 and again["silver_quality"]["mode"] == "unchanged"
    assert read_table(spark, cfg.root, "silver_ev_trips").count() == silver_rows


def test_pipeline_before_any_file(spark, tmp_dir):
    import os
    os.makedirs(f"{tmp_dir}/incoming")
    cfg = PipelineConfig(source_path=f"{tmp_dir}/incoming", root=f"{tmp_dir}/lake")
    assert run(spark, cfg) == {"bronze_rows_ingested": 0}


def test_command_line(spark, tmp_dir, capsys):
    import json
    from fleetframe.__main__ import main
    write_csv(telemetry(spark, SF_TINY), f"{tmp_dir}/in/b1", partitions=1)
    assert main(["run", "--source", f"{tmp_dir}/in", "--root", f"{tmp_dir}/lake",
                 "--now", "2024-01-01 00:00:00"]) == 0
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report["bronze_rows_ingested"] == 1000 and report["silver_quality"]["mode"] == "full"
    assert main(["run", "--source", f"{tmp_dir}/in", "--root", f"{tmp_dir}/lake", "--full-refresh"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["silver_quality"]["mode"] == "full"
