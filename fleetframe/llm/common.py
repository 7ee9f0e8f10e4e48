"""Helpers shared by the operators of this folder: Arrow text access and row keys."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from fleetframe.session import materialize, scratch_path  # noqa: F401  (used by the operators)
from fleetframe.sources.testbed import read_table  # noqa: F401

#: UTF-8 bytes handled at once inside a task; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20

# Names of the key columns that identify a document row between shuffles.
KEY = ["__row_id", "__row_hash"]


def with_row_key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Add the two never-null key columns of a document row.

    Rows with the same id and the same text share a key; every operator gives
    such rows the same result, so they need not be told apart.
    """
    return docs.withColumns({
        KEY[0]: F.coalesce(F.col(id_col).cast("long"), F.lit(0)),
        KEY[1]: F.xxhash64(F.col(id_col).cast("long"), F.col(text_col)),
    })


def crc32_fold(id_col: str, folds: int):
    """crc32 of the id's decimal text modulo ``folds`` (null id: NULL)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (length + 1) of a string column; nulls read as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``limit`` bytes together (one row at least)."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, list[str]]]:
    """Row ranges with their texts as Python strings; nulls read as empty."""
    if column.null_count:
        column = column.fill_null("")
    _, offsets = utf8(column)
    for lo, hi in blocks(offsets, limit):
        yield lo, hi, column.slice(lo, hi - lo).to_pylist()


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated ``arange(start, start + count)`` of every pair."""
    counts = counts.astype(np.int64)
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - counts), counts)


def _same_names(spark: SparkSession):
    """How the session compares column names: as a key function."""
    exact = spark.conf.get("spark.sql.caseSensitive", "false").lower() == "true"
    return (lambda name: name) if exact else str.lower


def other_columns(df: DataFrame, names: list[str]) -> dict[str, Column]:
    """The columns of ``df``, by name, that no result column of ``names`` replaces
    (names are compared in the session's way: by default without regard to case)."""
    key = _same_names(df.sparkSession)
    taken = {key(n) for n in names}
    return {c: df[f"`{c.replace('`', '``')}`"] for c in df.columns if key(c) not in taken}


class Plain:
    """A table under the column names c0, c1 ... by position, which no working or result
    column can clash with, whatever the names are."""

    def __init__(self, df: DataFrame):
        self.names = df.columns
        self.df = df.toDF(*[f"c{i}" for i in range(len(self.names))])
        self.key = _same_names(df.sparkSession)

    def find(self, name: str) -> str | None:
        """Plain name of a column (of an exact match if there is one)."""
        at = [i for i, n in enumerate(self.names) if n == name] or \
            [i for i, n in enumerate(self.names) if self.key(n) == self.key(name)]
        return f"c{at[0]}" if at else None

    def of(self, name: str) -> str:
        found = self.find(name)
        if found is None:
            raise ValueError(f"no column {name} among {self.names}")
        return found

    def kept(self, results: list[str]) -> dict[str, str]:
        """Plain name -> name of the columns that no result column replaces."""
        taken = {self.key(n) for n in results}
        return {f"c{i}": n for i, n in enumerate(self.names) if self.key(n) not in taken}


def append_columns(df: DataFrame, fn, schema: str) -> DataFrame:
    """Run ``fn(column) -> list of arrays`` on the last column of every Arrow batch
    (a copy of the text, removed again) and append the arrays as ``schema`` columns.

    A column of the input that has the name of a result column is replaced by it.
    """
    spark = df.sparkSession
    fields = spark.createDataFrame([], schema).schema.fields
    key = _same_names(spark)
    names = {key(f.name) for f in fields}
    source = df.toDF(*[f"c{i}" for i in range(len(df.columns))])  # any input name, dots and repeats included
    kept = [i for i, c in enumerate(df.columns[:-1]) if key(c) not in names]
    src = source.select(*[f"c{i}" for i in kept], f"c{len(df.columns) - 1}")
    out = source.select(*[f"c{i}" for i in kept]).schema
    for i, f in enumerate(fields):
        out = out.add(f"r{i}", f.dataType, f.nullable)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            arrays = fn(batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *arrays], names=[*batch.schema.names[:-1], *[f"r{i}" for i in range(len(arrays))]])

    return src.mapInArrow(run, out).toDF(*[df.columns[i] for i in kept], *[f.name for f in fields])


def append_to_table(docs: DataFrame, source, fn, schema: str) -> DataFrame:
    """``append_columns`` for a whole table: ``source(plain)`` is the column that ``fn`` gets,
    made of the table's ``Plain`` names; all columns but replaced ones are kept."""
    plain = Plain(docs)
    fields = docs.sparkSession.createDataFrame([], schema).columns
    kept = plain.kept(fields)
    out = append_columns(plain.df.select(*kept, source(plain).alias("source")), fn, schema)
    return out.toDF(*kept.values(), *fields)


def labelled_ids(labels: DataFrame, label_col: str, fold) -> DataFrame:
    """Rows (doc_id, label) of the labelled ids where ``fold`` holds, each id once."""
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
            .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & fold)
            .groupBy("doc_id").agg(F.max("label").alias("label")))


def first_labelled(docs: DataFrame, labels: DataFrame, label_col: str, fold, rows_per_class: int,
                   chars_per_class: int, columns: list[str], plain_chars: int = 1 << 40,
                   least_rows: int = 200) -> DataFrame:
    """A bounded, deterministic training sample: for each class the ``rows_per_class``
    labelled ids of smallest id hash that have a document, with their whole texts (a null
    text is an empty one).

    ``fold`` is a condition on ``doc_id``.  Where the texts of a class hold more than
    ``chars_per_class`` characters together, its longest ones are left out until they do
    not (the shortest always stays, so a class with texts is never empty).  A label says
    little about the words of a very long text: those over ``plain_chars`` characters are
    taken, the shortest first, only where a class has fewer than ``least_rows`` texts.  Of several
    rows with one id the one of least text hash stands for it.
    """
    ids = labelled_ids(labels, label_col, fold)
    own = F.struct(F.xxhash64("text").alias("h"), *[F.col(c) for c in columns])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c) for c in columns]).fillna("", ["text"])
    order = F.xxhash64(F.lit(label_col), F.col("doc_id"))
    there = ids.join(texts.select("doc_id"), "doc_id", "left_semi")
    picked = None
    for label in (0, 1):
        some = there.where(F.col("label") == label).orderBy(order, "doc_id").limit(rows_per_class)
        picked = some if picked is None else picked.unionAll(some)
    picked = materialize(picked, "picked-labels")  # 2 * rows_per_class ids at most
    rows = materialize(texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label").agg(F.min(own).alias("own"))
                       .select("doc_id", "label", *[F.col(f"own.{c}").alias(c) for c in columns]), "training-texts")
    by_length = Window.partitionBy("label").orderBy("n", "doc_id")
    fits = rows.select("doc_id", "label", F.length("text").cast("long").alias("n")) \
        .withColumns({"at": F.row_number().over(by_length), "sum": F.sum("n").over(by_length)}) \
        .where((F.col("at") == 1) | ((F.col("sum") <= chars_per_class) & (
            (F.col("n") <= plain_chars) | (F.col("at") <= least_rows)))).select("doc_id")
    return rows.join(F.broadcast(fits), "doc_id")


def session_of(df: DataFrame) -> SparkSession:
    return df.sparkSession
