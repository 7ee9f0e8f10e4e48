"""SimHash near-duplicates through a segment-popcount embedding.

A 64-bit fingerprint is cut into 32 segments of two bits; its embedding is the
bit count of every segment.  The Manhattan distance of two embeddings never
exceeds the Hamming distance of the fingerprints.  The grid join takes cells of
side one over half of the embedding's axes: the axes form 8 blocks, a distance of
4 or less leaves at least 4 blocks equal, so two linked fingerprints share the
cell of at least one of the 70 choices of 4 blocks.  Inside a cell the Manhattan
distance over all axes is the first filter, and the Hamming distance decides.

Counts are written in unary (00, 01, 11), so that the Manhattan distance of two
embeddings is the number of differing bits of their unary codes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetframe.llm.common import KEY, Plain, append_to_table, materialize, read_table, with_row_key
from fleetframe.llm.components import connected_components

SHINGLE, MAX_DISTANCE = 4, 4
AXIS_BLOCKS = 8
#: Fingerprints of one cell that a task links on its own; a larger cell is dealt out in block pairs.
CELL_ROWS = 20_000


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of a text's word shingles, as a signed 64-bit number.

    A-Z in lower case, words between ASCII white space, shingles joined by one
    space, XXH64 with seed 42; a bit is 1 if over half of the shingles set it.
    Fewer words than a shingle make one shingle, no words give 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = np.array([digest(joined, 42)], np.uint64)
    else:
        gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        starts = np.concatenate([[0], gaps + 1])[:len(words) - shingle + 1].tolist()
        ends = np.concatenate([gaps, [len(joined)]])[shingle - 1:].tolist()
        hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, ends)), np.uint64, len(starts))
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 16384):
        part = hashes[k:k + 16384].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = counts * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def with_fingerprints(docs: DataFrame, text_col: str, shingle: int, name: str) -> DataFrame:
    """Add the fingerprint (long) of every whole text; a null text reads as empty."""
    def run(column: pa.Array) -> list[pa.Array]:
        raw = column.fill_null("").cast(pa.binary()).to_pylist()
        return [pa.array([fingerprint(t, shingle) for t in raw], pa.int64())]

    return append_to_table(docs, lambda t: F.col(t.of(text_col)), run, f"`{name}` long")


def unary_code(fp):
    """Column: the segment bit counts of a fingerprint in unary."""
    odd = 0x5555555555555555
    high, low = F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(odd)), fp.bitwiseAND(F.lit(odd))
    return F.shiftleft(high.bitwiseAND(low), 1).bitwiseOR(high.bitwiseOR(low))


def _unary(fp: np.ndarray) -> np.ndarray:
    odd = np.uint64(0x5555555555555555)
    high, low = (fp >> np.uint64(1)) & odd, fp & odd
    return ((high & low) << np.uint64(1)) | high | low


def _close(one: np.ndarray, other: np.ndarray, code_one, code_other, distance: int) -> np.ndarray:
    near = np.flatnonzero(np.bitwise_count(code_one ^ code_other) <= distance)
    one = one if one.ndim == 0 else one[near]
    other = other if other.ndim == 0 else other[near]
    return near[np.bitwise_count(one ^ other) <= distance]


def link_cell(fps: np.ndarray, distance: int, edges: list) -> None:
    """Append a spanning forest of the links among distinct fingerprints of one cell.

    A breadth-first search compares each reached fingerprint with those not yet
    reached, so a dense cell takes few comparisons and gives fewer edges than rows.
    """
    codes, open_ = _unary(fps), np.arange(len(fps))
    while len(open_):
        queue, open_ = [open_[0]], open_[1:]
        while queue and len(open_):
            i = queue.pop()
            hit = _close(fps[i], fps[open_], codes[i], codes[open_], distance)
            if len(hit):
                found = open_[hit]
                edges.append((np.full(len(found), fps[i]), fps[found]))
                queue.extend(found.tolist())
                open_ = np.delete(open_, hit)


def link_cells(cell: np.ndarray, fps: np.ndarray, distance: int) -> list:
    """Edges among the rows of each cell (``cell``: sorted cell numbers)."""
    edges: list = []
    starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, np.int64)
    sizes = np.diff(np.concatenate([starts, [len(cell)]]))
    small = np.repeat(sizes <= 8, sizes)
    codes = _unary(fps)
    for d in range(1, 8):
        same = np.flatnonzero((cell[d:] == cell[:-d]) & small[d:]) if len(cell) > d else []
        if not len(same):
            break
        hit = same[_close(fps[same], fps[same + d], codes[same], codes[same + d], distance)]
        if len(hit):
            edges.append((fps[hit], fps[hit + d]))
    for k in np.flatnonzero(sizes > 8):
        link_cell(np.unique(fps[starts[k]:starts[k] + sizes[k]]), distance, edges)
    return edges


def _stream_cells(distance: int, cell_rows: int | None):
    """mapInArrow function over partitions sorted by cell (all columns but the last,
    the fingerprint); rows of cells over ``cell_rows`` come out again, marked."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = held_keys = held = passing = None

        def out(kind, keys, a, b):
            n = len(a)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, kind), pa.int32()), *[pa.array(k, pa.int64()) for k in keys],
                 pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["kind", *names, "a", "b"])

        def links(keys, fps, last):
            nonlocal passing
            if not len(fps):
                return
            new = np.zeros(len(fps), bool)
            new[0] = True
            for k in keys:
                new[1:] |= k[1:] != k[:-1]
            cell = np.cumsum(new)
            if cell_rows:
                big = np.bincount(cell)[cell] > cell_rows
                if passing is not None and all(k[0] == p for k, p in zip(keys, passing)):
                    big |= cell == 1
                if big.any():
                    yield out(1, [k[big] for k in keys], fps[big], fps[big])
                    if last is not None:
                        passing = [k[-1] for k in keys] if big[-1] else None
                    cell, fps = cell[~big], fps[~big]
            edges = link_cells(cell, fps, distance)
            if edges:
                a, b = (np.concatenate(x) for x in zip(*edges))
                pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
                yield out(0, [np.zeros(pairs.shape[1], np.int64)] * len(names), pairs[0], pairs[1])

        for batch in batches:
            names = batch.schema.names[:-1]
            keys = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:-1]]
            fps = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).view(np.uint64)
            if held is not None:
                keys = [np.concatenate([a, b]) for a, b in zip(held_keys, keys)]
                fps = np.concatenate([held, fps])
            if not len(fps):
                continue
            tail = np.ones(len(fps), bool)
            for k in keys:
                tail &= k == k[-1]
            cut = int(np.argmax(tail))
            if cell_rows and len(fps) - cut > cell_rows:
                cut = len(fps)
            yield from links([k[:cut] for k in keys], fps[:cut], cut)
            held_keys, held = [k[cut:] for k in keys], fps[cut:]
        if held is not None:
            yield from links(held_keys, held, None)

    return run


def near_links(fingerprints: DataFrame, distance: int = MAX_DISTANCE, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Edges (a, b) whose components are those of all links among distinct
    fingerprints (column fp); ``distance`` below the number of axis blocks."""
    width = 64 // AXIS_BLOCKS
    masks = []
    for chosen in combinations(range(AXIS_BLOCKS), AXIS_BLOCKS - distance):
        mask = sum(((1 << width) - 1) << (width * b) for b in chosen)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    cells = fingerprints.select("fp", F.posexplode(F.array(*[unary_code(F.col("fp")).bitwiseAND(F.lit(m))
                                                             for m in masks])).alias("grid", "cell")) \
        .select(F.col("grid").cast("long").alias("grid"), "cell", "fp")
    schema = "kind int, grid long, cell long, a long, b long"
    first = materialize(cells.repartition("grid", "cell").sortWithinPartitions("grid", "cell")
                        .mapInArrow(_stream_cells(distance, cell_rows), schema), "simhash-links")
    edges = first.where("kind = 0").select("a", "b")
    large = first.where("kind = 1").select("grid", "cell", F.col("a").alias("fp"))
    sizes = large.groupBy("grid", "cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(cell_rows / 2)).alias("parts"))
    # block pairs (i <= j) of an over-full cell; each pair is a cell of its own
    part = F.pmod(F.xxhash64("fp"), F.col("parts"))
    dealt = large.join(sizes, ["grid", "cell"]).withColumn("part", part).select(
        "grid", "cell", "fp", "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other")
    ).select("grid", "cell", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "fp")
    pairs = dealt.repartition("grid", "cell", "i", "j").sortWithinPartitions("grid", "cell", "i", "j").mapInArrow(
        _stream_cells(distance, None), "kind int, grid long, cell long, i long, j long, a long, b long")
    return edges.unionAll(pairs.where("kind = 0").select("a", "b"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = SHINGLE, distance: int = MAX_DISTANCE) -> DataFrame:
    """One row per document: its row key, id, fp (long) and component_id, the smallest
    id reachable over links of ``distance`` differing bits or fewer.

    Rows with equal fingerprints (copies, and all texts without words) are linked.
    Null ids count for no component's smallest id; a component of rows with null
    ids alone has a null component_id.
    """
    keyed = with_row_key(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")), "__id", "__text")
    rows = materialize(with_fingerprints(keyed, "__text", shingle, "fp").select(
        *KEY, F.col("__id").cast("long").alias("doc_id"), "fp"), "fingerprints")
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints-distinct")
    linked = connected_components(near_links(distinct.select("fp"), distance))
    rooted = materialize(distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
                         .select("fp", "least", F.coalesce("root", "fp").alias("root")), "fingerprint-roots")
    # written before the join, so that a component of very many fingerprints can be split
    least = materialize(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "component-ids")
    return rows.join(rooted.join(least, "root").select("fp", "component_id"), "fp") \
        .select(*KEY, "doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = SHINGLE, distance: int = MAX_DISTANCE) -> DataFrame:
    """The rows of ``docs``, one of each component: that of the smallest id (then row
    hash); of fully repeated rows one stays.  Rows whose id is null count as id 0."""
    plain = Plain(docs)
    id_col, text_col = plain.of(id_col), plain.of(text_col)
    found = simhash_components(plain.df, id_col, text_col, shingle, distance)
    group = F.coalesce("component_id", F.lit(-1)), F.when(F.col("component_id").isNull(), F.col("fp"))
    kept = found.groupBy(*[g.alias(f"__g{i}") for i, g in enumerate(group)]).agg(F.min(F.struct(*KEY)).alias("k")) \
        .select(*[F.col(f"k.{c}").alias(c) for c in KEY])
    keyed = with_row_key(plain.df, id_col, text_col)
    return keyed.join(kept, KEY, "left_semi").dropDuplicates(KEY).drop(*KEY).toDF(*plain.names)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row of ``documents``."""
    found = simhash_components(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
