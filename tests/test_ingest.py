"""CSV sources: header alignment, stream = batch, idempotent re-runs."""

from conftest import rows_of
import os

from pyspark.sql import functions as F

from fleetframe.operators.cleaning import clean_telemetry
from fleetframe.sources.csv import list_csv_files, read_header, read_telemetry_csv, write_csv
from fleetframe.sources.testbed import telemetry
from fleetframe.streaming.ingest import run_ingest
from conftest import SF_TINY


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_headers_aligned_by_name(spark, tmp_dir):
    _write(f"{tmp_dir}/a.csv", "VehId,Trip,DayNum,Timestamp(ms),Energy_Consumption\n1,1,1.5,100,2.5\n")
    _write(f"{tmp_dir}/b.csv", "Energy_Consumption,Timestamp(ms),DayNum,Trip,VehId\nNaN,200,2.5,3,2\n")
    _write(f"{tmp_dir}/sub/c.csv",
           "VehId,Trip,DayNum,Timestamp(ms),Energy_Consumption,New Signal\n3,4,3.25,300,nan,9\n4,5\n")
    assert len(list_csv_files(tmp_dir)) == 3
    assert read_header(f"{tmp_dir}/b.csv")[0] == "Energy_Consumption"
    raw = read_telemetry_csv(spark, tmp_dir)
    assert "New Signal" in raw.columns
    rows = {r["VehId"]: r for r in clean_telemetry(raw).collect()}
    assert rows[1]["energy"] == 2.5 and rows[1]["ts_ms"] == 100 and rows[1]["DayNum"] == 1.5
    assert rows[2]["energy"] is None and rows[2]["Trip"] == 3 and rows[2]["ts_ms"] == 200
    assert rows[3]["energy"] is None and rows[3]["DayNum"] == 3.25
    assert rows[4]["Trip"] == 5 and rows[4]["DayNum"] is None      # short row
    assert rows[1]["lat"] is None                                   # column absent everywhere


def test_stream_equals_batch_and_rerun_is_idempotent(spark, tmp_dir):
    raw = telemetry(spark, SF_TINY)
    src, sink, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt"
    write_csv(raw.filter(F.col("Trip") % 2 == 0), f"{src}/d1", partitions=2)
    first = run_ingest(spark, src, sink, ckpt)
    write_csv(raw.filter(F.col("Trip") % 2 != 0), f"{src}/d2", partitions=2)
    second = run_ingest(spark, src, sink, ckpt)
    third = run_ingest(spark, src, sink, ckpt)
    total = raw.count()
    assert first > 0 and first + second == total and third == 0
    streamed = clean_telemetry(spark.read.parquet(sink))
    batch = clean_telemetry(read_telemetry_csv(spark, src))
    direct = clean_telemetry(raw)
    assert rows_of(streamed) == rows_of(batch) == rows_of(direct)
    assert "ingestion_timestamp" in spark.read.parquet(sink).columns


def test_stream_aligns_different_headers(spark, tmp_dir):
    src, sink, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt"
    _write(f"{src}/a.csv", "VehId,Trip,DayNum,Energy_Consumption\n1,1,1.5,2.5\n")
    _write(f"{src}/b.csv", "Trip,VehId,DayNum,New Col\n9,3,3.5,x\n")       # mixed backlog
    assert run_ingest(spark, src, sink, ckpt) == 2
    _write(f"{src}/0_old.csv", "VehId,Trip,DayNum,Energy_Consumption\n2,1,2.5,3.5\n")
    _write(f"{src}/empty.csv", "")
    assert run_ingest(spark, src, sink, ckpt) == 1                          # the old header again
    rows = spark.read.option("mergeSchema", True).parquet(sink).collect()
    assert sorted((r["VehId"], r["Trip"], r["Energy_Consumption"], r["New Col"]) for r in rows if r["VehId"] != "3") \
        == [("1", "1", "2.5", None), ("2", "1", "3.5", None)]
    assert [(r["Trip"], r["New Col"]) for r in rows if r["VehId"] == "3"] == [("9", "x")]


def test_repeated_batch_is_stored_once(spark, tmp_dir):
    import glob
    src, sink, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt"
    _write(f"{src}/a.csv", "VehId,Trip\n1,1\n")
    assert run_ingest(spark, src, sink, ckpt) == 1
    _write(f"{src}/b.csv", "VehId,Trip\n2,1\n")
    assert run_ingest(spark, src, sink, ckpt) == 1
    last = sorted(glob.glob(f"{ckpt}/commits/[0-9]*"), key=lambda p: int(p.rsplit("/", 1)[1]))[-1]
    os.remove(last)                                    # as if the run had died before its commit
    for crc in glob.glob(f"{ckpt}/commits/.{os.path.basename(last)}.crc"):
        os.remove(crc)
    assert run_ingest(spark, src, sink, ckpt) == 1     # the batch again, in the same folder
    assert sorted(r["VehId"] for r in spark.read.parquet(sink).collect()) == ["1", "2"]


def test_observation_counts_failed_rules(spark, tmp_dir):
    from fleetframe.operators.quality import Rule, observe_and_drop
    df = spark.createDataFrame([(1, 0.0), (2, 5.0), (3, None)], "id int, d double")
    kept, obs = observe_and_drop(df, [Rule("positive", "d > 0")], "t1")
    kept.write.parquet(f"{tmp_dir}/out")
    assert obs.get == {"rows_in": 3, "failed_positive": 2}
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 1


def test_header_discovery(spark, tmp_dir):
    for i in range(12):
        header = "VehId,Trip,DayNum" if i % 3 else "DayNum,VehId,Trip"
        row = f"{i},{i + 100},{i}.5" if i % 3 else f"{i}.5,{i},{i + 100}"
        _write(f"{tmp_dir}/f{i:02d}.csv", f"{header}\n{row}\n")
    rows = clean_telemetry(read_telemetry_csv(spark, tmp_dir)).collect()
    assert sorted((r["VehId"], r["Trip"], r["DayNum"]) for r in rows) == [
        (i, i + 100, i + 0.5) for i in range(12)]


def test_missing_trip_keys_fail_loudly(spark):
    import pytest
    df = spark.createDataFrame([("1", "2.5")], "VehId string, Energy_Consumption string")
    with pytest.raises(ValueError, match="DayNum"):
        clean_telemetry(df)


def test_backlog_in_several_batches(spark, tmp_dir):
    from fleetframe.streaming.ingest import ingest_csv_stream
    raw = telemetry(spark, SF_TINY)
    write_csv(raw, f"{tmp_dir}/src/d1", partitions=5)
    written = []
    ingest_csv_stream(spark, f"{tmp_dir}/src", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt",
                      max_files_per_trigger=2, written=written).awaitTermination()
    assert len(written) == 3
    assert spark.read.parquet(f"{tmp_dir}/sink").count() == raw.count()


def test_header_with_byte_order_mark(spark, tmp_dir):
    path = f"{tmp_dir}/bom.csv"
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write("VehId,Trip,DayNum\n5,6,7.5\n")
    assert read_header(path) == ("VehId", "Trip", "DayNum")
    row = clean_telemetry(read_telemetry_csv(spark, tmp_dir)).first()
    assert (row["VehId"], row["Trip"], row["DayNum"]) == (5, 6, 7.5)
