"""Small ingest batches of bronze rewritten as one clustered folder.

Every stream batch has a folder of its own, so files get small and many, and each
one spans all vehicles.  ``compact_bronze`` rewrites all batches but the last (the only
one that a crashed stream may repeat) along the curve of vehicle and day, into the
folder ``ingest_batch=-1``, which no stream batch ever replaces.

The old folders go only after the new one is complete and a note of the exchange has been
written; a run that dies in between is finished by ``resume_compaction``.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession, functions as F, types as T

from fleetframe.operators.clustering import clustered
from fleetframe.plans.catalog import TABLES, schema_log_path, table_path
from fleetframe.schema import SAMPLE_TYPES
from fleetframe.sources.files import child_names, move_dir, path_exists, read_text, remove_dir, write_text
from fleetframe.sources.schema_log import SchemaLog, log_exists
from fleetframe.streaming.ingest import BATCH_COLUMN

NAME = "bronze_ev_telemetry"
#: Batch number of the rewritten rows.
COMPACTED = -1


def batch_numbers(root: str) -> list[int]:
    """Numbers of the batches in bronze, from its folder names."""
    return sorted(int(n.split("=", 1)[1]) for n in child_names(table_path(root, NAME)) if n.startswith(f"{BATCH_COLUMN}="))


def _note(root: str) -> str:
    return f"{root.rstrip('/')}/_state/compaction.json"


def compact_bronze(spark: SparkSession, root: str) -> int:
    """Rewrite all batches but the last; the number of folders that became one."""
    resume_compaction(root)
    numbers = batch_numbers(root)[:-1]
    if len(numbers) < 2:
        return 0
    path = table_path(root, NAME)
    reader = spark.read.option("mergeSchema", True)
    if log_exists(schema_log_path(root, NAME)):
        stored = {**SAMPLE_TYPES, "ingestion_timestamp": T.TimestampType()}
        columns = SchemaLog(schema_log_path(root, NAME)).latest().columns
        reader = spark.read.schema(T.StructType(
            [T.StructField(n, stored.get(n, T.StringType())) for n, _ in columns]).add(BATCH_COLUMN, T.LongType()))
    rows = reader.parquet(path).filter(F.col(BATCH_COLUMN) <= F.lit(numbers[-1])).drop(BATCH_COLUMN)
    staged = f"{root.rstrip('/')}/_staging/{NAME}-compacted"
    clustered(rows, TABLES[NAME].cluster_by).write.mode("overwrite").parquet(staged)
    write_text(_note(root), json.dumps({"staged": staged, "batches": numbers}))
    resume_compaction(root)
    return len(numbers)


def resume_compaction(root: str) -> bool:
    """Finish an exchange of folders whose note is there; whether there was one."""
    if not path_exists(_note(root)):
        return False
    note, path = json.loads(read_text(_note(root))), table_path(root, NAME)
    if path_exists(note["staged"]):
        for number in note["batches"]:
            remove_dir(f"{path}/{BATCH_COLUMN}={number}")
        move_dir(note["staged"], f"{path}/{BATCH_COLUMN}={COMPACTED}")
    remove_dir(_note(root))
    return True
