"""Append-only log of the column types that a growing set of files was accepted with.

Every version is one small file, ``<folder>/<number>.json``, never changed once written.
A new batch of files is compared with the latest version: columns that appeared are added
behind the known ones, and a column whose new values do not fit its type is widened
(whole number -> fractional, date -> timestamp, anything else -> text).  Nothing is ever
narrowed or removed, so a reader that takes the latest version can read every file, and
knows all columns without opening one.

Source columns stay text on disk: widening needs no rewriting, loses nothing, and takes
effect for all rows at once.  ``read_logged`` gives them their logged types.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from fleetframe.functions.numeric import missing_text
from fleetframe.sources.files import child_names, create_text, path_exists, read_text

# Names of the types that text is taken for, and what holds both of two different ones.
VOID, BOOLEAN, LONG, DOUBLE, DATE, TIMESTAMP, TEXT = (
    "void", "boolean", "bigint", "double", "date", "timestamp_ntz", "string")
_WIDER = {frozenset((LONG, DOUBLE)): DOUBLE, frozenset((DATE, TIMESTAMP)): TIMESTAMP}

#: Columns whose types one aggregate looks at (a header may have thousands).
_AT_ONCE = 40


def widen(a: str, b: str) -> str:
    """The narrowest type that holds the values of both."""
    if a == b or b == VOID:
        return a
    return b if a == VOID else _WIDER.get(frozenset((a, b)), TEXT)


def _fits(text: Column) -> dict[str, Column]:
    """For each type, narrow ones first, whether a value that is not missing reads as it."""
    def reads(pattern: str, kind: str) -> Column:
        return text.rlike(pattern) & text.try_cast(kind).isNotNull()

    return {BOOLEAN: reads("^(?i)(true|false)$", BOOLEAN),
            LONG: reads(r"^[+-]?\d+$", LONG),
            DOUBLE: reads(r"^[+-]?[\d.]", DOUBLE),
            DATE: reads(r"^\d{4}-\d{2}-\d{2}$", DATE),
            TIMESTAMP: reads(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?$", TIMESTAMP)
            | reads(r"^\d{4}-\d{2}-\d{2}$", DATE)}


def infer_types(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """The narrowest type of each text column over all rows (``void`` without values):
    one aggregate for every 40 columns, combined in the tasks."""
    found = {}
    for at in range(0, len(columns), _AT_ONCE):
        aggs, part = [], columns[at:at + _AT_ONCE]
        for i, name in enumerate(part):
            text = F.trim(F.col(f"`{name}`"))
            present = ~missing_text(text)
            aggs += [F.bool_and(F.when(present, fits)).alias(f"{i}_{kind}") for kind, fits in _fits(text).items()]
        row = df.agg(*aggs).first()
        for i, name in enumerate(part):
            kinds = {k: row[f"{i}_{k}"] for k in (BOOLEAN, LONG, DOUBLE, DATE, TIMESTAMP)}
            found[name] = VOID if None in kinds.values() else next((k for k, ok in kinds.items() if ok), TEXT)
    return found


@dataclass(frozen=True)
class SchemaVersion:
    number: int
    note: str
    columns: tuple[tuple[str, str], ...]  # (name, type), in order

    def types(self) -> dict[str, str]:
        return dict(self.columns)


class SchemaLog:
    """The log in one folder.  Several writers may share it: a version number is taken
    by whoever creates its file first, the other one merges again."""

    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")

    def versions(self) -> list[int]:
        names = [n.removesuffix(".json") for n in child_names(self.folder) if n.endswith(".json")]
        return sorted(int(n) for n in names if n.isdigit())

    def load(self, number: int) -> SchemaVersion:
        entry = json.loads(read_text(f"{self.folder}/{number}.json"))
        return SchemaVersion(entry["version"], entry["note"], tuple((c["name"], c["type"]) for c in entry["columns"]))

    def latest(self) -> SchemaVersion | None:
        numbers = self.versions()
        return self.load(numbers[-1]) if numbers else None

    def accept(self, found: dict[str, str], note: str = "") -> SchemaVersion:
        """Merge the types of new rows into the log; a new version only if something changed.
        Names are compared without regard to case, as Spark does; the first spelling stays."""
        while True:
            last = self.latest()
            merged = dict(last.columns) if last else {}
            spelling = {name.lower(): name for name in merged}
            for name, kind in found.items():
                known = spelling.setdefault(name.lower(), name)
                merged[known] = widen(merged[known], kind) if known in merged else kind
            columns = tuple(merged.items())
            if last is not None and columns == last.columns:
                return last
            version = SchemaVersion(last.number + 1 if last else 0, note, columns)
            text = json.dumps({"version": version.number, "note": note,
                               "columns": [{"name": n, "type": k} for n, k in columns]}, indent=1)
            if create_text(f"{self.folder}/{version.number}.json", text):
                return version


def found_types(batch: DataFrame, settled: dict[str, str], fixed: dict[str, str]) -> dict[str, str]:
    """Types of a written batch: those of ``fixed`` and of typed columns as they are, text
    columns by their values.  Columns the log already holds as text are not looked at."""
    names = {n.lower(): k for n, k in settled.items()}
    plain = {f.name: f.dataType.simpleString() for f in batch.schema.fields}
    looked = [n for n, k in plain.items() if k == TEXT and n not in fixed and names.get(n.lower()) != TEXT]
    inferred = infer_types(batch, looked)
    return {n: fixed.get(n, inferred.get(n, k)) for n, k in plain.items()}


def read_logged(spark: SparkSession, path: str, log: SchemaLog, stored: dict[str, T.DataType],
                partition: tuple[str, T.DataType] | None = None) -> DataFrame:
    """A folder of Parquet batches by the latest logged version.  ``stored`` names the columns
    that are typed on disk, all others are text there; no file is opened to find columns."""
    version = log.latest()
    if version is None:
        raise FileNotFoundError(f"no schema has been accepted in {log.folder}")
    schema = T.StructType([T.StructField(n, stored.get(n, T.StringType())) for n, _ in version.columns])
    if partition:
        schema = schema.add(*partition)
    out = []
    for name, kind in version.columns:
        column = F.col(f"`{name}`")
        if name not in stored and kind not in (TEXT, VOID):
            text = F.trim(column)
            column = F.when(~missing_text(text), text.try_cast(kind)).alias(name)
        out.append(column)
    return spark.read.schema(schema).parquet(path).select(*out, *([partition[0]] if partition else []))


def log_exists(folder: str) -> bool:
    return path_exists(folder) and bool(SchemaLog(folder).versions())
