"""Telemetry CSV files: header-aware batch reads and CSV writes.

Spark binds CSV columns by position once a schema is given, so a file whose
header lists the same columns in another order (or adds one) would be read
into the wrong columns without any error.  ``read_telemetry_csv`` therefore:

1. lists the files and reads only the first lines of each, in tasks;
2. groups files by their exact header;
3. reads each group with a text schema built from that header (one
   distributed read per distinct header, not per file);
4. unions the groups by column name; columns a file lacks become NULL.

Typing and NaN handling happen afterwards in ``operators.cleaning``.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterable, Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from fleetframe.sources.files import first_line, list_files


def list_csv_files(path: str) -> list[str]:
    """Files under ``path`` (a file or a folder) by the rule of Spark's readers."""
    return list_files(path)


def read_header(path: str) -> tuple[str, ...]:
    """Columns of the first line that is not blank; () where there is none."""
    return _parsed(first_line(path))


def _parsed(line: str) -> tuple[str, ...]:
    return tuple(next(csv.reader(io.StringIO(line)), []))


def _first_lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line that is not blank of the file whose lines come in; stops reading there."""
    for batch in batches:
        for line, path, start in zip(*(c.to_pylist() for c in batch.columns)):
            if start:
                return  # a later part of a large file
            line = line.removeprefix("\ufeff")
            if line.strip():
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([line])], ["path", "line"])
                return


def header_lines(spark: SparkSession, files: list[str]) -> dict[str, str]:
    """First line of each file that has one, read by tasks: one task for each file (or
    part of a large one), which ends after its first lines."""
    own = spark.newSession()  # for settings of this read alone
    own.conf.set("spark.sql.files.openCostInBytes", own.conf.get("spark.sql.files.maxPartitionBytes", "134217728b"))
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    lines = own.read.text([_literal(f) for f in files]).select(
        "value", F.col("_metadata.file_path"), F.col("_metadata.file_block_start"))
    found = lines.mapInArrow(_first_lines, "path string, line string").collect()  # one row for each file
    return {_listed(r["path"]): r["line"] for r in found}


def _listed(path: str) -> str:
    """A file's name as listings give it, from the escaped form that readers report."""
    path = unquote(path)
    return "file:" + path[len("file://"):] if path.startswith("file:///") else path


def header_groups(files: list[str], spark: SparkSession | None = None) -> dict[tuple[str, ...], list[str]]:
    """Files grouped by exact header (files without a header line are skipped)."""
    if not files:
        return {}
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, line in header_lines(spark or SparkSession.getActiveSession(), files).items():
        header = _parsed(line)
        if header:
            groups.setdefault(header, []).append(path)
    return {h: sorted(fs) for h, fs in groups.items()}


def text_schema(header: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType(), True) for name in header])


def _literal(path: str) -> str:
    """A path whose glob characters stand for themselves."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def read_csv_group(spark: SparkSession, files: list[str], header: tuple[str, ...],
                   malformed: str | None = None) -> DataFrame:
    """Files of one header as text columns.  ``malformed`` names a further column for the
    text of lines with more or fewer fields than the header (their fields are read as far
    as they go)."""
    reader = (spark.read.option("header", True)
              .option("enforceSchema", True)  # schema *is* this group's header
              .option("mode", "PERMISSIVE"))
    schema = text_schema(header)
    if malformed:
        schema = schema.add(malformed, T.StringType())
        reader = reader.option("columnNameOfCorruptRecord", malformed)
    return reader.schema(schema).csv([_literal(f) for f in files])


def read_csv_files(spark: SparkSession, files: list[str], malformed: str | None = None) -> DataFrame | None:
    """The given files as text columns, aligned by header name; None where no file has a header."""
    frames = [read_csv_group(spark, fs, h, malformed) for h, fs in sorted(header_groups(files, spark).items())]
    if not frames:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_telemetry_csv(spark: SparkSession, path: str) -> DataFrame:
    """All CSV files under ``path`` as text columns, aligned by header name."""
    out = read_csv_files(spark, list_csv_files(path))
    if out is None:
        raise FileNotFoundError(f"no CSV files with a header under {path}")
    return out


def write_csv(df: DataFrame, path: str, partitions: int | None = None) -> None:
    """Header CSV, text as is, NULL as empty field."""
    out = df.repartition(partitions) if partitions else df
    out.write.mode("overwrite").option("header", True).csv(path)
