"""Incremental refreshes produce the same tables as one full build."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_TINY, rows_of
from fleetframe.plans.catalog import TABLES, read_table
from fleetframe.plans.pipeline import PipelineConfig, run
from fleetframe.sources.csv import write_csv
from fleetframe.sources.testbed import telemetry

NOW = "2024-01-01 00:00:00"
SKIP = {"bronze_ev_telemetry"}  # run numbers differ by construction


def _cfg(tmp_dir, name):
    return PipelineConfig(source_path=f"{tmp_dir}/{name}/incoming", root=f"{tmp_dir}/{name}/lake",
                          now=NOW, chunks=3)


def _tables(spark, cfg):
    out = {}
    for name in TABLES:
        if name in SKIP:
            continue
        df = read_table(spark, cfg.root, name)
        out[name] = rows_of(df.drop(*[c for c in df.columns if c.endswith("timestamp")]))
    return out


def _drops(spark):
    raw = telemetry(spark, SF_TINY)
    even = F.coalesce((F.col("Trip") * 0 + F.col("Timestamp(ms)")) % 2 == 0, F.lit(True))
    # samples of the same trip land in both drops
    return raw.filter(even), raw.filter(~even)


def test_incremental_equals_full(spark, tmp_dir):
    first, second = _drops(spark)
    inc = _cfg(tmp_dir, "inc")
    write_csv(first, f"{inc.source_path}/d1", partitions=2)
    assert run(spark, inc)["silver_quality"]["mode"] == "full"
    write_csv(second, f"{inc.source_path}/d2", partitions=2)
    report = run(spark, inc)["silver_quality"]
    assert report["mode"] == "incremental" and report["days"] > 0

    full = _cfg(tmp_dir, "full")
    write_csv(first, f"{full.source_path}/d1", partitions=2)
    write_csv(second, f"{full.source_path}/d2", partitions=2)
    run(spark, full)
    assert _tables(spark, inc) == _tables(spark, full)
    assert run(spark, inc)["silver_quality"]["mode"] == "unchanged"


def test_vehicle_class_change_rebuilds(spark, tmp_dir):
    # a session default of dynamic overwrite must not leave the removed vehicle's days behind
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        _vehicle_class_change_rebuilds(spark, tmp_dir)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def _vehicle_class_change_rebuilds(spark, tmp_dir):
    first, _ = _drops(spark)
    ev_id = first.filter(F.col("VehId") % 5 == 2).agg(F.min("VehId")).first()[0]
    turned = first.filter(F.col("VehId") == ev_id).limit(1).withColumn("Fuel Rate[L/hr]", F.lit("2.0"))
    inc = _cfg(tmp_dir, "inc2")
    write_csv(first, f"{inc.source_path}/d1", partitions=2)
    run(spark, inc)
    assert read_table(spark, inc.root, "ev_vehicles").filter(F.col("VehId") == ev_id).count() == 1
    write_csv(turned, f"{inc.source_path}/d2", partitions=1)
    assert run(spark, inc)["silver_quality"]["mode"] == "full"
    assert read_table(spark, inc.root, "silver_ev_trips").filter(F.col("VehId") == ev_id).count() == 0

    full = _cfg(tmp_dir, "full2")
    write_csv(first, f"{full.source_path}/d1", partitions=2)
    write_csv(turned, f"{full.source_path}/d2", partitions=1)
    run(spark, full)
    assert _tables(spark, inc) == _tables(spark, full)


def test_sample_without_daynum_rebuilds(spark, tmp_dir):
    first, _ = _drops(spark)
    ev_id = first.filter(F.col("VehId") % 5 == 2).agg(F.min("VehId")).first()[0]
    undated = first.filter(F.col("VehId") == ev_id).limit(1).withColumn("DayNum", F.lit(None).cast("double"))
    inc = _cfg(tmp_dir, "inc3")
    write_csv(first, f"{inc.source_path}/d1", partitions=2)
    run(spark, inc)
    write_csv(undated, f"{inc.source_path}/d2", partitions=1)
    assert run(spark, inc)["silver_quality"]["mode"] == "full"
    full = _cfg(tmp_dir, "full3")
    write_csv(first, f"{full.source_path}/d1", partitions=2)
    write_csv(undated, f"{full.source_path}/d2", partitions=1)
    run(spark, full)
    assert _tables(spark, inc) == _tables(spark, full)


@pytest.fixture(scope="module")
def turned_vehicle(spark, tmp_path_factory):
    """A first drop, a second one that turns an EV into a hybrid and adds samples, and
    the tables of one full build over both."""
    first, second = _drops(spark)
    ev_id = first.filter(F.col("VehId") % 5 == 2).agg(F.min("VehId")).first()[0]
    turned = first.filter(F.col("VehId") == ev_id).limit(1).withColumn("Fuel Rate[L/hr]", F.lit("2.0"))
    drop = second.unionByName(turned)
    full = _cfg(str(tmp_path_factory.mktemp("full")), "full")
    write_csv(first, f"{full.source_path}/d1", partitions=2)
    write_csv(drop, f"{full.source_path}/d2", partitions=2)
    run(spark, full)
    return first, drop, _tables(spark, full)


@pytest.mark.parametrize("step", ["build_silver", "refresh_vehicles", "build_gold", "build_ml_features"])
def test_run_repeated_after_a_crash(spark, tmp_dir, turned_vehicle, step, monkeypatch):
    from fleetframe.plans import pipeline
    first, drop, expected = turned_vehicle
    cfg = _cfg(tmp_dir, "crash")
    write_csv(first, f"{cfg.source_path}/d1", partitions=2)
    run(spark, cfg)
    write_csv(drop, f"{cfg.source_path}/d2", partitions=2)
    real = getattr(pipeline, step)

    def dies(*args):
        if step == "refresh_vehicles":
            real(*args)                     # after its tables are replaced
        raise RuntimeError("executor and driver lost")

    monkeypatch.setattr(pipeline, step, dies)
    with pytest.raises(RuntimeError):
        run(spark, cfg)
    monkeypatch.setattr(pipeline, step, real)
    assert run(spark, cfg)["silver_quality"]["mode"] == "full"
    assert _tables(spark, cfg) == expected
    assert run(spark, cfg)["silver_quality"]["mode"] == "unchanged"


def test_strict_switch_rebuilds_and_missing_source_fails(spark, tmp_dir):
    first, _ = _drops(spark)
    cfg = _cfg(tmp_dir, "strict")
    with pytest.raises(FileNotFoundError):
        run(spark, cfg)
    write_csv(first, f"{cfg.source_path}/d1", partitions=2)
    run(spark, cfg)
    cfg.strict = True
    assert run(spark, cfg)["silver_quality"]["mode"] == "full"
