"""Incremental CSV ingestion with Structured Streaming.

A file-source stream with an ``availableNow`` trigger: each run picks up the
files that arrived since the last run (tracked in the checkpoint), appends
their rows with an ingestion time to a Parquet table, and stops.  Re-running
without new files adds nothing.

The stream carries file names, not lines (the content column of the source is
pruned).  Each micro-batch reads its files grouped by header and aligned by
column name, like the batch reader, so a file may reorder, add or lack columns.
A batch is written to a folder of its own, ``ingest_batch=<id>``; a batch that is
repeated after a crash replaces that folder, so rows are stored exactly once.

With ``schema_dir`` the columns and types of every batch are merged into a schema log
(``sources.schema_log``) before the batch counts as done: a later run, or a reader,
knows all columns and their widest types without opening old files.  Without it, added
columns are found by reading the table with ``mergeSchema``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetframe.operators.cleaning import MALFORMED, RESCUED, clean_telemetry
from fleetframe.sources.csv import read_csv_files
from fleetframe.sources.schema_log import TEXT, SchemaLog, found_types

#: Partition column of the sink: the number of the micro-batch, growing over all runs.
BATCH_COLUMN = "ingest_batch"
#: Samples of a batch are sorted on these, where present, so row groups cover few days.
SORT_COLUMNS = ("DayNum", "VehId")

_FILES = "path string, modificationTime timestamp, length long, content binary"


def csv_file_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of the paths of files arriving under ``source_dir``, sub-folders included."""
    reader = spark.readStream.format("binaryFile").schema(_FILES).option("recursiveFileLookup", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(source_dir).select("path")


def ingest_csv_stream(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str, now=None,
                      max_files_per_trigger: int | None = None,
                      transform: Callable[[DataFrame], DataFrame] | None = None,
                      written: list[str] | None = None, schema_dir: str | None = None) -> StreamingQuery:
    """Start one ``availableNow`` run: new files -> appended Parquet rows.

    ``transform`` is applied to each batch before writing (the pipeline types
    and renames the signals here, so bronze is stored compactly, once).
    Folders of finished batches are added to ``written``."""
    def append(batch: DataFrame, batch_id: int) -> None:
        # file names of one batch, at most max_files_per_trigger
        rows = read_csv_files(batch.sparkSession, sorted(r["path"] for r in batch.collect()),
                              MALFORMED if transform is typed_samples else None)
        if rows is None:
            return
        if transform is not None:
            rows = transform(rows)
        rows = rows.withColumn("ingestion_timestamp", now if now is not None else F.current_timestamp())
        order = [c for c in SORT_COLUMNS if c in rows.columns]
        if order:
            rows = rows.sortWithinPartitions(*order)
        folder = f"{sink_dir.rstrip('/')}/{BATCH_COLUMN}={batch_id}"
        rows.write.mode("overwrite").parquet(folder)
        if schema_dir is not None:
            log = SchemaLog(schema_dir)
            last = log.latest()
            stored = batch.sparkSession.read.schema(rows.schema).parquet(folder)  # text columns only are looked at
            log.accept(found_types(stored, last.types() if last else {}, {RESCUED: TEXT}), f"batch {batch_id}")
        if written is not None:
            written.append(folder)

    return (csv_file_stream(spark, source_dir, max_files_per_trigger)
            .writeStream.foreachBatch(append)
            .option("checkpointLocation", checkpoint_dir)
            .trigger(availableNow=True)
            .start())


def run_ingest(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
               now=None, timeout_s: float | None = None,
               transform: Callable[[DataFrame], DataFrame] | None = None,
               max_files_per_trigger: int | None = None, schema_dir: str | None = None) -> int:
    """Run one triggered ingestion to completion; returns the rows appended, counted
    in the batches it wrote (the query's progress list keeps only its last entries)."""
    written: list[str] = []
    query = ingest_csv_stream(spark, source_dir, sink_dir, checkpoint_dir, now,
                              max_files_per_trigger, transform, written, schema_dir)
    query.awaitTermination(timeout_s)
    if query.isActive:
        query.stop()
        raise TimeoutError("ingestion did not finish in time")
    if query.exception() is not None:
        raise query.exception()
    if not written:
        return 0
    return spark.read.schema("ingestion_timestamp timestamp").parquet(*written).count()


def typed_samples(rows: DataFrame) -> DataFrame:
    """Canonical, typed signals, the text that failed its type, and any extra source columns (as text)."""
    return clean_telemetry(rows, keep_extra=True, rescue=True)
