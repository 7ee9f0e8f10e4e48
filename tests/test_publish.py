"""Constraints before publishing, broken replacements, clustering on two columns, compaction."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_TINY, rows_of
from fleetframe.operators.clustering import BITS, clustered, curve_place, range_bounds
from fleetframe.operators.quality import ConstraintError, Rule, audit, require
from fleetframe.plans import catalog, compact
from fleetframe.plans.catalog import TABLES, describe_table, read_table, restore_tables, table_path, write_table
from fleetframe.plans.inspect import plan_text
from fleetframe.plans.queries import feature_rows
from fleetframe.sources import files
from fleetframe.sources.csv import write_csv
from fleetframe.sources.testbed import telemetry

NAME = "ml_features_energy_prediction"


@pytest.fixture(scope="module")
def features(spark):
    from fleetframe.session import materialize
    return materialize(feature_rows(spark, SF_TINY), "publish-test")


def test_audit(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 1), (None, 2), (None, 2), (3, None)], "a int, b int")
    rules = (Rule("a_there", "a IS NOT NULL"), Rule("b_small", "b < 10"))
    assert audit(df, rules, ("a", "b")) == {"a_there": 2, "b_small": 1, "unique(a, b)": 3}
    assert audit(df.limit(0), rules, ("a",)) == {} == audit(df)
    with pytest.raises(ConstraintError, match="a_there: 2 rows"):
        require(df, rules)


@pytest.mark.parametrize("fault", ["repeated key", "null vehicle"])
def test_rejected_rows_leave_the_table(spark, tmp_dir, features, fault):
    write_table(features, tmp_dir, NAME)
    before = rows_of(read_table(spark, tmp_dir, NAME))
    assert before and describe_table(tmp_dir, NAME)["unique"] and "pk_trip_notnull" in describe_table(tmp_dir, NAME)["constraints"]
    one = features.limit(1)
    bad = features.unionByName(one if fault == "repeated key" else one.withColumn("VehId", F.lit(None).cast("long")))
    with pytest.raises(ConstraintError) as e:
        write_table(bad, tmp_dir, NAME)
    assert list(e.value.failures.values()) == [1]
    assert rows_of(read_table(spark, tmp_dir, NAME)) == before
    assert glob.glob(f"{tmp_dir}/_staging/{NAME}-*/*.parquet")            # the rejected rows, to look at


def test_rejected_run_leaves_the_published_features(spark, tmp_dir, monkeypatch):
    from fleetframe.plans import pipeline
    raw = telemetry(spark, SF_TINY)
    write_csv(raw.filter("Trip % 2 = 0"), f"{tmp_dir}/in/a", partitions=1)
    cfg = pipeline.PipelineConfig(f"{tmp_dir}/in", f"{tmp_dir}/lake", now="2024-01-01 00:00:00", chunks=2)
    pipeline.run(spark, cfg)
    before = rows_of(read_table(spark, cfg.root, NAME))
    write_csv(raw.filter("Trip % 2 = 1"), f"{tmp_dir}/in/b", partitions=1)
    real = pipeline.features_from_history
    monkeypatch.setattr(pipeline, "features_from_history", lambda *a: (lambda df: df.unionByName(df.limit(1)))(real(*a)))
    with pytest.raises(ConstraintError):
        pipeline.run(spark, cfg)
    assert rows_of(read_table(spark, cfg.root, NAME)) == before
    monkeypatch.setattr(pipeline, "features_from_history", real)
    pipeline.run(spark, cfg)
    assert len(rows_of(read_table(spark, cfg.root, NAME))) > len(before)


def test_broken_replacement_is_restored(spark, tmp_dir, features, monkeypatch):
    write_table(features, tmp_dir, NAME)
    before = rows_of(read_table(spark, tmp_dir, NAME))
    path = table_path(tmp_dir, NAME)
    os.rename(path, files._retired(path))                   # as if the run had died between the two renames
    assert restore_tables(tmp_dir) == [NAME] and rows_of(read_table(spark, tmp_dir, NAME)) == before
    os.rename(path, files._retired(path))
    write_table(features.limit(3), tmp_dir, NAME)           # or a new write follows at once
    assert read_table(spark, tmp_dir, NAME).count() == 3 and not os.path.exists(files._retired(path))
    assert restore_tables(tmp_dir) == []


# --- clustering ---------------------------------------------------------------------

def _skipped(folder, column, value):
    """Share of row groups whose statistics exclude a value."""
    groups = skipped = 0
    for name in glob.glob(f"{folder}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(name).metadata
        at = next(i for i in range(meta.num_columns) if meta.schema.column(i).name == column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            groups += 1
            skipped += not (stats.min <= value <= stats.max)
    return skipped / groups


def _grid(spark):
    return spark.range(64_000).select((F.xxhash64("id") % 500 + 500).alias("VehId"),
                                      (F.pmod(F.hash("id"), F.lit(300)) + F.lit(0.5)).alias("DayNum"), "id")


def test_row_groups_are_skipped_for_either_column(spark, tmp_dir):
    df = _grid(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        clustered(df, ["VehId", "DayNum"]).write.parquet(f"{tmp_dir}/curve")
        df.repartitionByRange("VehId", "DayNum").sortWithinPartitions("VehId", "DayNum").write.parquet(f"{tmp_dir}/sorted")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert rows_of(spark.read.parquet(f"{tmp_dir}/curve")) == rows_of(df)
    for vehicle, day in ((77, 20.5), (450, 250.5)):
        assert _skipped(f"{tmp_dir}/curve", "VehId", vehicle) > 0.7 and _skipped(f"{tmp_dir}/curve", "DayNum", day) > 0.7
        assert _skipped(f"{tmp_dir}/sorted", "DayNum", day) < 0.1
    text = plan_text(spark.read.parquet(f"{tmp_dir}/curve").filter("VehId = 77 AND DayNum >= 20"), "formatted")
    assert "EqualTo(VehId,77)" in text and "GreaterThanOrEqual(DayNum,20.0)" in text


def test_curve_place(spark):
    df = _grid(spark).unionByName(spark.range(3).select(F.lit(None).cast("long").alias("VehId"), F.lit(1.5).alias("DayNum"), "id"))
    bounds = range_bounds(df, ["VehId", "DayNum"])
    assert all(len(b) == (1 << BITS) - 1 for b in bounds.values())
    for r in df.withColumn("p", curve_place(df, bounds)).filter("id % 997 = 0 OR VehId IS NULL").collect():
        numbers = [sum(v is not None and v > x for x in b) for v, b in zip((r.VehId, r.DayNum), bounds.values())]
        want = sum((n >> bit & 1) << (2 * bit + 1 - j) for j, n in enumerate(numbers) for bit in range(BITS))
        assert r.p == want
    same = spark.createDataFrame([(1, 1.0)] * 5, "VehId long, DayNum double")
    assert clustered(same, ["VehId", "DayNum"]).count() == 5
    assert clustered(same.limit(0), ["VehId", "DayNum"]).count() == 0


# --- compaction ----------------------------------------------------------------------

def _ingested(spark, tmp_dir, drops=3):
    from fleetframe.plans.pipeline import PipelineConfig, run
    raw = telemetry(spark, SF_TINY)
    cfg = PipelineConfig(f"{tmp_dir}/in", f"{tmp_dir}/lake", now="2024-01-01 00:00:00", chunks=2, compact_batches=100)
    from fleetframe.plans.pipeline import ingest_bronze
    for k in range(drops):
        part = raw.filter(F.pmod("`Timestamp(ms)`", F.lit(drops)) == k)
        write_csv(part.withColumn(f"extra{k}", F.lit(str(k))), f"{tmp_dir}/in/d{k}", partitions=2)
        ingest_bronze(spark, cfg) if k < drops - 1 else run(spark, cfg)
    return cfg


def _samples(spark, cfg):
    return rows_of(read_table(spark, cfg.root, "bronze_ev_telemetry").drop("ingest_batch"))


def test_compaction(spark, tmp_dir, monkeypatch):
    from fleetframe.plans.pipeline import run
    cfg = _ingested(spark, tmp_dir)
    before = _samples(spark, cfg)
    assert compact.batch_numbers(cfg.root) == [0, 1, 2]
    real = compact.move_dir
    monkeypatch.setattr(compact, "move_dir", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError):
        compact.compact_bronze(spark, cfg.root)              # dies when the old folders are gone
    monkeypatch.setattr(compact, "move_dir", real)
    assert compact.resume_compaction(cfg.root) and not compact.resume_compaction(cfg.root)
    assert compact.batch_numbers(cfg.root) == [-1, 2] and _samples(spark, cfg) == before
    assert compact.compact_bronze(spark, cfg.root) == 0
    write_csv(telemetry(spark, SF_TINY).filter("Trip = 3"), f"{tmp_dir}/in/again", partitions=1)
    cfg.compact_batches = 2
    result = run(spark, cfg)
    assert result["silver_quality"]["mode"] == "incremental" and result["bronze_batches_compacted"] == 2
    assert compact.batch_numbers(cfg.root) == [-1, 3] and len(_samples(spark, cfg)) > len(before)
    assert run(spark, cfg)["silver_quality"]["mode"] == "unchanged"
    assert TABLES["bronze_ev_telemetry"].interleaved and catalog.log_exists(catalog.schema_log_path(cfg.root, "bronze_ev_telemetry"))
