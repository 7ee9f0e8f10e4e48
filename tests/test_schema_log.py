"""Schema log, rescued text, headers read by tasks."""

import json
import os

import pytest
from pyspark.sql import functions as F, types as T

from fleetframe.operators.cleaning import MALFORMED, RESCUED, clean_telemetry, rescued_counts, rescued_values
from fleetframe.plans.catalog import read_table, schema_log_path, table_path
from fleetframe.sources import csv as csv_source
from fleetframe.sources.csv import header_groups, header_lines, list_csv_files, read_csv_files
from fleetframe.sources.files import create_text, read_text
from fleetframe.sources.schema_log import SchemaLog, infer_types, widen
from fleetframe.streaming.ingest import run_ingest, typed_samples


def _write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)


def test_widening_is_a_join():
    kinds = ["void", "boolean", "bigint", "double", "date", "timestamp_ntz", "string"]
    for a in kinds:
        assert widen(a, a) == a and widen(a, "void") == a and widen(a, "string") == "string"
        for b in kinds:
            assert widen(a, b) == widen(b, a)
            for c in kinds:
                assert widen(widen(a, b), c) == widen(a, widen(b, c))
    assert widen("bigint", "double") == "double" and widen("date", "timestamp_ntz") == "timestamp_ntz"
    assert widen("bigint", "boolean") == widen("date", "double") == "string"


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_inferred_types(spark, ansi):
    columns = {"empty": [None, " ", "NaN"], "flag": ["true", "FALSE", None], "whole": [" 7", "-3", "nan"],
               "part": ["1", "2.5", ".5"], "day": ["2024-02-29", "2024-03-01", ""], "when": ["2024-02-29", "2024-03-01 10:00", "2024-03-01T10:00:00.5"],
               "text": ["1", "x", None], "bad day": ["2024-02-30", "2024-03-01", None], "huge": ["1", "99999999999999999999", None],
               "mixed": ["true", "1", None], "zip": ["1e5", "7", None], "a.b`c": ["1", "2", "3"]}
    rows = list(zip(*columns.values()))
    df = spark.createDataFrame(rows, T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(columns))]))
    names = [n.replace("`", "") for n in columns]
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert infer_types(df.toDF(*names), names) == dict(zip(names, [
            "void", "boolean", "bigint", "double", "date", "timestamp_ntz", "string", "string", "double", "string", "double", "bigint"]))
        assert infer_types(df.limit(0).toDF(*names), names) == {n: "void" for n in names}
        wide = df.select(*[F.col("c2").alias(f"w{i}") for i in range(95)])
        assert infer_types(wide, wide.columns) == {c: "bigint" for c in wide.columns}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_log_is_append_only(spark, tmp_dir):
    log = SchemaLog(f"{tmp_dir}/log")
    assert log.latest() is None
    assert log.accept({"a": "bigint", "B": "void"}, "first").number == 0
    assert log.accept({"A": "void", "b": "void"}).number == 0                # nothing new, names without case
    first = read_text(f"{tmp_dir}/log/0.json")
    assert log.accept({"a": "double", "c": "date"}, "second").columns == (("a", "double"), ("B", "void"), ("c", "date"))
    assert log.accept({"a": "bigint"}).number == 1                           # never narrowed, never dropped
    assert read_text(f"{tmp_dir}/log/0.json") == first and SchemaLog(f"{tmp_dir}/log").versions() == [0, 1]
    assert json.loads(first)["note"] == "first"


def test_log_with_two_writers(spark, tmp_dir, monkeypatch):
    a, b = SchemaLog(f"{tmp_dir}/log"), SchemaLog(f"{tmp_dir}/log")
    a.accept({"x": "bigint"})
    seen = a.latest()
    stale = [seen]                            # b has read the log before a adds a version
    a.accept({"x": "double"})
    real = b.latest
    monkeypatch.setattr(b, "latest", lambda: stale.pop() if stale else real())
    assert b.accept({"y": "string"}).columns == (("x", "double"), ("y", "string"))
    assert a.versions() == [0, 1, 2]
    assert not create_text(f"{tmp_dir}/log/2.json", "other") and "double" in read_text(f"{tmp_dir}/log/2.json")


def test_schema_survives_restart(spark, tmp_dir):
    """A widened and an added column over two runs; the second run and the reader open no old file."""
    root, src = f"{tmp_dir}/lake", f"{tmp_dir}/in"
    run = lambda: run_ingest(spark, src, table_path(root, "bronze_ev_telemetry"), f"{tmp_dir}/ckpt", transform=typed_samples,
                             schema_dir=schema_log_path(root, "bronze_ev_telemetry"))
    _write(f"{src}/a.csv", "VehId,Trip,DayNum,aux,none\n1,1,1.5,7,\n2,1,1.5,NaN,\n")
    assert run() == 2
    log = SchemaLog(schema_log_path(root, "bronze_ev_telemetry"))
    assert log.latest().types()["aux"] == "bigint" and log.latest().types()["none"] == "void"
    assert dict(read_table(spark, root, "bronze_ev_telemetry").dtypes)["aux"] == "bigint"
    folder = f"{table_path(root, 'bronze_ev_telemetry')}/ingest_batch=0"
    for name in os.listdir(folder):                # an unreadable old footer must not matter for columns
        if name.endswith(".parquet"):
            os.rename(f"{folder}/{name}", f"{folder}/.{name}")
    _write(f"{src}/b.csv", "aux,VehId,Trip,DayNum,Flag,when\n2.5,3,1,2.5,true,2024-01-02\n")
    _write(f"{src}/c.csv", "VehId,Trip,DayNum\n4,1,2.5\n")
    assert run() == 2
    for name in os.listdir(folder):
        if name.startswith(".part") and name.endswith(".parquet"):
            os.rename(f"{folder}/{name}", f"{folder}/{name[1:]}")
    table = read_table(spark, root, "bronze_ev_telemetry")
    types = dict(table.dtypes)
    assert (types["aux"], types["Flag"], types["when"], types["VehId"], types["none"]) == ("double", "boolean", "date", "bigint", "string")
    rows = {r["VehId"]: r for r in table.collect()}
    assert [rows[k]["aux"] for k in (1, 2, 3, 4)] == [7.0, None, 2.5, None]
    assert rows[3]["Flag"] is True and rows[1]["Flag"] is None and [rows[k]["ingest_batch"] for k in (1, 3)] == [0, 1]
    assert log.versions() == [0, 1] and "ingestion_timestamp" in types
    _write(f"{src}/d.csv", "VehId,Trip,DayNum,aux\n5,1,1.5,x\n")
    assert run() == 1
    assert {r["VehId"]: r["aux"] for r in read_table(spark, root, "bronze_ev_telemetry").collect()} == {
        1: "7", 2: "NaN", 3: "2.5", 4: None, 5: "x"}                           # the text itself again


def test_rescued_text(spark):
    schema = "VehId string, Trip string, DayNum string, `Timestamp(ms)` string, Energy_Consumption string, lat double, other string"
    raw = spark.createDataFrame([("8.5", "1", "x", "3", "NaN", 1.0, "?"), ("8", " ", "1.5", "1e30", "", float("nan"), None),
                                 ("7", "1", "1", "1", "1.5", 2.0, "?"), (None, "nan", "1", "", 'say "no"', None, "")], schema)
    out = clean_telemetry(raw, rescue=True)
    assert out.columns[-1] == RESCUED and clean_telemetry(raw).columns == out.columns[:-1]
    got = [json.loads(r[RESCUED]) if r[RESCUED] else None for r in out.collect()]
    assert got == [{"VehId": "8.5", "DayNum": "x"}, {"Timestamp(ms)": "1e30"}, None, {"Energy_Consumption": 'say "no"'}]
    assert sorted(map(tuple, rescued_counts(out).collect())) == [
        ("DayNum", 1), ("Energy_Consumption", 1), ("Timestamp(ms)", 1), ("VehId", 1), ("_no_key", 3)]
    assert sorted(map(tuple, rescued_values(out).collect())) == [
        ("DayNum", "x"), ("Energy_Consumption", 'say "no"'), ("Timestamp(ms)", "1e30"), ("VehId", "8.5")]
    assert rescued_counts(out.limit(0)).count() == 0
    typed = spark.createDataFrame([(8.5, 1), (8.0, 1)], "VehId double, Trip int").withColumn("DayNum", F.lit(1.5))
    assert [r[RESCUED] for r in clean_telemetry(typed, rescue=True).collect()] == ['{"VehId":"8.5"}', None]


def test_malformed_lines(spark, tmp_dir):
    _write(f"{tmp_dir}/in/a.csv", 'VehId,Trip,DayNum\n1,1,1.5\n2,1,1.5,surplus\n3,1\n"4",1,"1,5"\n')
    _write(f"{tmp_dir}/in/b.csv", "DayNum,Trip,VehId,Note\n1.5,2,5,ok\n")
    raw = read_csv_files(spark, list_csv_files(f"{tmp_dir}/in"), MALFORMED)
    out = {r["VehId"]: r[RESCUED] for r in clean_telemetry(raw, rescue=True).collect()}
    assert out == {1: None, 2: '{"_line":"2,1,1.5,surplus"}', 3: '{"_line":"3,1"}', 4: '{"DayNum":"1,5"}', 5: None}
    assert run_ingest(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt", transform=typed_samples) == 5
    stored = spark.read.option("mergeSchema", True).parquet(f"{tmp_dir}/out")
    assert MALFORMED not in stored.columns and {r["VehId"]: r["Note"] for r in stored.collect()}[5] == "ok"
    assert dict(map(tuple, rescued_counts(stored).collect())) == {"_line": 2, "DayNum": 1, "_no_key": 2}


def test_run_reports_rescued_values(spark, tmp_dir):
    from fleetframe.plans.pipeline import PipelineConfig, run
    header = "VehId,Trip,DayNum,Timestamp(ms),HV Battery SOC[%]\n"
    _write(f"{tmp_dir}/in/a.csv", header + "1,1,1.5,0,50\n1,1,1.5,9000,49\n1.5,1,1.5,1,50\n")
    cfg = PipelineConfig(f"{tmp_dir}/in", f"{tmp_dir}/lake", now="2024-01-01 00:00:00", chunks=2)
    assert run(spark, cfg)["rescued"] == {"VehId": 1, "_no_key": 1}
    _write(f"{tmp_dir}/in/b.csv", header + "1,2,2.5,0,full\n1,2,2.5,9000,49\n")
    assert run(spark, PipelineConfig(f"{tmp_dir}/in", f"{tmp_dir}/lake", now=cfg.now, chunks=2))["rescued"] == {"HV Battery SOC[%]": 1}
    bronze = read_table(spark, cfg.root, "bronze_ev_telemetry")
    assert bronze.count() == 5 and bronze.where(F.col(RESCUED).isNotNull()).count() == 2


def test_headers_are_read_by_tasks(spark, tmp_dir, monkeypatch):
    body = "1,1\n" * 50_000
    for i in range(12):
        _write(f"{tmp_dir}/in/f{i}.csv", ("VehId,Trip\n" if i % 3 else "﻿Trip,VehId\n") + body)
    _write(f"{tmp_dir}/in/sub/[x] {{y}} 50%+é.csv", "\n \r\nVehId,Trip\r\n1,1\r\n")
    _write(f"{tmp_dir}/in/empty.csv", "")
    _write(f"{tmp_dir}/in/blank.csv", "\n\n")
    files = list_csv_files(f"{tmp_dir}/in")
    want = {}
    for path in files:
        header = csv_source.read_header(path)
        if header:
            want.setdefault(header, []).append(path)
    monkeypatch.setattr(csv_source, "first_line", lambda path: pytest.fail("the driver opened a file"))
    assert header_groups(files) == {h: sorted(fs) for h, fs in want.items()}
    assert len(want[("VehId", "Trip")]) == 9 and len(header_lines(spark, files)) == 13
    assert header_groups([]) == {}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")         # the read of a header has its own settings
    try:
        assert read_csv_files(spark, files).count() == 12 * 50_000 + 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
