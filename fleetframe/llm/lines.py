"""Repeated lines across documents, found with two Bloom filters.

One pass over the text sets a once-seen and a twice-seen filter from line
hashes.  The filters of all tasks are merged block by block in Spark; a line can
only be repeated if the merged twice-seen filter holds it.  Only such suspects
are shuffled, where exact counting confirms them and chooses the occurrence that
stays.  False positives of the filters cost a shuffled digest and nothing else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetframe.llm.common import KEY, Plain, append_columns, materialize, read_table, with_row_key

#: Fixed values of the key: white space stripped at both ends, least length in code points.
STRIPPED = b" \t\n\x0b\x0c\r"
LEAST_CHARS, LEAST_DOCS = 20, 3
#: Bits of each filter (its size is what is broadcast: 8 MiB) and blocks it is merged in.
FILTER_BITS, FILTER_BLOCKS = 26, 64


def line_key(line: bytes) -> bytes:
    """Stripped line with A-Z in lower case; empty where it is too short to count."""
    key = line.strip(STRIPPED)
    if len(key) < LEAST_CHARS:
        return b""
    if len(key) < 4 * LEAST_CHARS and not key.isascii() and len(key.decode("utf-8", "replace")) < LEAST_CHARS:
        return b""
    return key.lower()


def _keys(column: pa.Array) -> Iterator[set[bytes]]:
    for text in column.cast(pa.binary()).to_pylist():
        keys = {line_key(x) for x in text.split(b"\n")} if text else set()
        keys.discard(b"")
        yield keys


def _positions(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << bits) - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) & mask).astype(np.int64)


class SeenFilters:
    """Once-seen and twice-seen Bloom filters with two hash functions."""

    def __init__(self, bits: int):
        self.bits = bits
        self.once = np.zeros(1 << (bits - 3), np.uint8)
        self.twice = np.zeros(1 << (bits - 3), np.uint8)

    def holds(self, filt: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        a, b = _positions(hashes, self.bits)
        return ((filt[a >> 3] >> (a & 7).astype(np.uint8)) & (filt[b >> 3] >> (b & 7).astype(np.uint8)) & 1) == 1

    def put(self, filt: np.ndarray, hashes: np.ndarray) -> None:
        for p in _positions(hashes, self.bits):
            np.bitwise_or.at(filt, p >> 3, np.uint8(1) << (p & 7).astype(np.uint8))

    def add(self, hashes: np.ndarray) -> None:
        distinct, times = np.unique(hashes, return_counts=True)
        self.put(self.twice, distinct[(times > 1) | self.holds(self.once, distinct)])
        self.put(self.once, distinct)

    def blocks(self, count: int) -> Iterator[tuple[int, bytes, bytes]]:
        """Non-empty blocks; each filter as places (uint32) and values of its non-zero bytes."""
        size = len(self.once) // count
        for k in range(count):
            once = self.once[k * size:(k + 1) * size]
            if once.any():
                yield k, _sparse(once), _sparse(self.twice[k * size:(k + 1) * size])


def _sparse(block: np.ndarray) -> bytes:
    at = np.flatnonzero(block).astype(np.uint32)
    if 5 * len(at) >= len(block):
        return b"D" + block.tobytes()
    return b"S" + len(at).to_bytes(4, "little") + at.tobytes() + block[at].tobytes()


def _dense(packed: bytes, size: int) -> np.ndarray:
    if packed[:1] == b"D":
        return np.frombuffer(packed, np.uint8, offset=1)
    n = int.from_bytes(packed[1:5], "little")
    block = np.zeros(size, np.uint8)
    block[np.frombuffer(packed, np.uint32, n, 5)] = np.frombuffer(packed, np.uint8, n, 5 + 4 * n)
    return block


def twice_seen_filter(docs: DataFrame, text_col: str = "text", bits: int = FILTER_BITS) -> np.ndarray:
    """Merged twice-seen filter (2^bits bits, a fixed size) over all lines of all documents.

    Merging two tasks: a line that both have seen once has now been seen twice, so
    ``twice = twice1 | twice2 | (once1 & once2)`` and ``once = once1 | once2``.
    """
    size = (1 << (bits - 3)) // FILTER_BLOCKS

    def fill(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, any_line = SeenFilters(bits), False
        for batch in batches:
            hashes = [xxhash.xxh3_64_intdigest(k) for keys in _keys(batch.column(0).fill_null("")) for k in keys]
            if hashes:
                any_line = True
                seen.add(np.array(hashes, np.uint64))
        for row in seen.blocks(FILTER_BLOCKS) if any_line else ():
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in
                                              zip(row, (pa.int32(), pa.binary(), pa.binary()))], schema.names)

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for k, once, twice in zip(*(c.to_pylist() for c in batch.columns)):
                once, twice = _dense(once, size), _dense(twice, size)
                have = merged.setdefault(k, [np.zeros(size, np.uint8), np.zeros(size, np.uint8)])
                have[1] |= twice | (have[0] & once)
                have[0] |= once
        for k, (_, twice) in merged.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([twice.tobytes()], pa.binary())],
                                             ["block", "twice"])

    schema = pa.schema([("block", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])
    parts = docs.select(F.col(text_col)).mapInArrow(fill, "block int, once binary, twice binary")
    out = np.zeros(1 << (bits - 3), np.uint8)
    # FILTER_BLOCKS rows of a fixed size in all
    for row in parts.repartition(FILTER_BLOCKS, "block").mapInArrow(merge, "block int, twice binary").collect():
        out[row.block * size:(row.block + 1) * size] = np.frombuffer(row.twice, np.uint8)
    return out


def repeated_lines(keyed: DataFrame, id_col: str, text_col: str, bits: int, least_docs: int) -> DataFrame:
    """Rows (row key, digest): the lines that each document loses."""
    spark = keyed.sparkSession
    shared = spark.sparkContext.broadcast(twice_seen_filter(keyed, text_col, bits))

    def suspects(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tester = SeenFilters(3)
        tester.bits = bits
        for batch in batches:
            rows, digests = [], []
            for i, keys in enumerate(_keys(batch.column(3).fill_null(""))):
                keys = list(keys)
                if not keys:
                    continue
                hashes = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)
                for j in np.flatnonzero(tester.holds(shared.value, hashes)).tolist():
                    rows.append(i)
                    digests.append(hashlib.sha256(keys[j]).digest())
            if rows:
                rows = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays([*(batch.column(k).take(rows) for k in range(3)),
                                                  pa.array(digests, pa.binary())],
                                                 [*KEY, "__id", "__digest"])

    held = materialize(
        keyed.select(*KEY, F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text"))
        .mapInArrow(suspects, f"{KEY[0]} long, {KEY[1]} long, __id long, __digest binary"), "line-suspects")
    # written first: a join of two plain shuffles can split a very common line
    confirmed = materialize(held.groupBy("__digest").agg(F.count(F.lit(1)).alias("__docs"), F.max("__id").alias("__last"))
                            .where(F.col("__docs") >= least_docs).select("__digest", "__last"), "confirmed-lines")
    return held.join(confirmed, "__digest").where(~F.col("__id").eqNullSafe(F.col("__last"))).select(*KEY, "__digest")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                bits: int = FILTER_BITS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Drop lines whose key (``line_key``) occurs in ``least_docs`` documents or more,
    except in the document of largest id that holds it.

    Returns every row with its columns, the text without the dropped lines, and
    ``n_lines`` (before) and ``n_dropped``.  A line repeated in the staying
    document stays there each time.  Rows that share the largest id all keep the
    line; a null id is below all others, and keys that only rows with a null id
    hold stay.  A null text stays null and counts as one empty line.  Input columns
    named n_lines or n_dropped are replaced.
    """
    plain, names = Plain(docs), ["n_lines", "n_dropped"]
    id_col, text_col = plain.of(id_col), plain.of(text_col)
    stay = plain.kept(names)
    keyed = with_row_key(plain.df, id_col, text_col)
    lost = repeated_lines(keyed, id_col, text_col, bits, least_docs)
    per_doc = lost.groupBy(*KEY).agg(F.collect_set("__digest").alias("__lost"))
    packed = keyed.join(per_doc, KEY, "left").select(
        *[c for c in stay if c != text_col], F.struct(F.col(text_col).alias("t"), F.col("__lost").alias("d")).alias("pair"))

    def rebuild(column: pa.Array) -> list[pa.Array]:
        raw = column.field(0).cast(pa.binary()).to_pylist()
        lost_sets = column.field(1).to_pylist()
        n_lines, n_dropped = [], []
        for i, (text, gone) in enumerate(zip(raw, lost_sets)):
            n_lines.append(1 + (text.count(b"\n") if text else 0))
            n_dropped.append(0)
            if text and gone:
                gone, lines = set(gone), text.split(b"\n")
                kept = [x for x in lines if not (k := line_key(x)) or hashlib.sha256(k).digest() not in gone]
                n_dropped[-1] = len(lines) - len(kept)
                raw[i] = b"\n".join(kept)
        return [pa.array(raw, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()),
                pa.array(n_dropped, pa.int64())]

    out = append_columns(packed, rebuild, f"{text_col} string, n_lines long, n_dropped long")
    return out.select(*stay, *names).toDF(*stay.values(), *names)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every row of ``documents``."""
    out = dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH doc AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
line AS (SELECT rid, doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line FROM doc),
keyed AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line),
held AS (SELECT key, count(DISTINCT rid) AS docs, max(doc_id) AS last FROM keyed WHERE length(key) >= 20 GROUP BY key),
marked AS (SELECT k.*, coalesce(h.docs >= 3 AND k.doc_id IS DISTINCT FROM h.last, false) AS gone
           FROM keyed k LEFT JOIN held h ON k.key = h.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY rid
"""
