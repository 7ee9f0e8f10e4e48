"""Nearest neighbours from randomly rotated one-bit codes.

Every vector is centred, rotated by one random orthogonal matrix and kept as the
signs of its coordinates (packed bits) with two correction scalars: its distance
to the centre and the inner product of its direction with its code.  For a
query these give an unbiased estimate of the inner product and a bound of its
error; only candidates whose lower distance bound beats the best ones found so
far are ranked by the true distance.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from fleetframe.llm.common import materialize, read_table, scratch_path

#: Width of the error bound in standard deviations of the estimate.
BOUND = 4.0
#: Share of the squared lengths by which rounding may raise a bound; what counts as an outlier for the centre.
ROUNDING, OUTLIER = 1e-9, 1e4
#: Queries handled in one pass over the index, and candidates ranked together in a task.
QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 2048


def rotation(dims: int, seed: int = 17) -> np.ndarray:
    """Random orthogonal matrix, the same on every executor."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Rows (vec_id, vec) that take part: id, vector and components not null, all
    components finite and not all zero."""
    vec = F.col(vec_col).cast("array<double>")
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec")).where(
        F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)
        & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists("vec", lambda x: x != 0.0))


def centre(rows: DataFrame) -> tuple[int, np.ndarray]:
    """Most common length (the smaller if tied) and mean vector of the rows of that
    length; partial sums are made in the tasks.

    Any centre gives valid bounds; one far from most vectors gives loose ones.  Vectors
    with a component over OUTLIER times the median of the greatest ones are left out of it."""
    dims = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if dims is None:
        return 0, np.zeros(0)
    own = rows.where(F.size("vec") == dims.d)
    greatest = F.array_max(F.transform("vec", F.abs))
    limit = OUTLIER * own.agg(F.percentile_approx(greatest, 0.5)).first()[0]

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(dims.d), 0
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0), dims.d)
                x = x[np.abs(x).max(1) <= limit]
                total, n = total + x.sum(0), n + len(x)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.tolist()])], ["n", "s"])

    parts = own.select("vec").mapInArrow(sums, "n long, s array<double>")
    added = parts.select("n", F.posexplode("s").alias("i", "x")).groupBy("i").agg(
        F.sum("x").alias("s"), F.sum("n").alias("n")).orderBy("i").collect()  # one row for each dimension
    middle = np.array([r.s / max(r.n, 1) for r in added])
    return dims.d, np.where(np.isfinite(middle), middle, 0.0)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def build_index(rows: DataFrame, dims: int, middle: np.ndarray, seed: int = 17) -> DataFrame:
    """Rows (vec_id, code, norm, cosine, vec): packed sign bits of the rotated
    direction, distance to the centre, inner product of direction and code."""
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(dims, seed)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), dims) - middle
            with np.errstate(over="ignore", invalid="ignore"):
                norm = np.sqrt((x * x).sum(1))
                # an infinite length leaves no direction; its bound then says nothing
                turned = (x / np.where((norm > 0) & np.isfinite(norm), norm, 1)[:, None]) @ turn
            bits = np.packbits(turned >= 0, axis=1)
            cosine = np.abs(turned).sum(1) / np.sqrt(dims)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([b.tobytes() for b in bits], pa.binary()), pa.array(norm), pa.array(cosine),
                 batch.column(1)], ["vec_id", "code", "norm", "cosine", "vec"])

    return rows.where(F.size("vec") == dims).mapInArrow(
        encode, "vec_id long, code binary, norm double, cosine double, vec array<double>")


def _true_distance(query: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Euclidean distances, squares added in the order of the dimensions.  Where squares
    leave the range of doubles, differences are scaled by a power of two before."""
    gap = query - candidates
    most = np.abs(gap).max(1, initial=0.0)
    scaled = (most > 0) & ((most < 1e-145) | (most > 1e145))
    if scaled.any():
        # halved first: the difference of two extreme values may exceed every double
        half = query / 2 - candidates[scaled] / 2
        exponent = np.frexp(np.abs(half).max(1))[1]
        gap[scaled] = np.ldexp(half, -exponent[:, None])
    total = np.zeros(len(candidates))
    for d in range(len(query)):
        total += gap[:, d] ** 2
    total = np.sqrt(total)
    if scaled.any():
        total[scaled] = np.ldexp(total[scaled], exponent + 1)
    return total


def search_block(query_ids, queries, turned, q_norm, batches, dims: int, k: int, bound: float):
    """The k nearest of one task's candidates for each query: (query, vec_id, score) arrays."""
    np.seterr(over="ignore", invalid="ignore")  # in a task of its own
    best_d = np.full((len(queries), k), np.inf)
    best_id = np.full((len(queries), k), np.iinfo(np.int64).max)
    for ids, codes, norm, cosine, vec in batches:
        signs = (np.unpackbits(codes, axis=1, count=dims).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(dims))
        safe = np.where(cosine > 0, cosine, 1.0)
        wide = bound * np.sqrt(np.maximum(1 - safe ** 2, 0)) / safe / np.sqrt(max(dims - 1, 1))
        estimate = turned @ signs.T / safe  # of the inner product of the directions
        size = q_norm[:, None] ** 2 + norm ** 2
        # less what rounding may have added; where a square overflows there is no bound (NaN)
        low = size * (1 - ROUNDING) - 2 * q_norm[:, None] * norm * np.minimum(estimate + wide, 1.0)
        for i in range(len(queries)):
            worst = best_d[i, -1]
            near = np.flatnonzero(~(low[i] > worst * worst * (1 + 1e-9)))  # without a bound: rank it
            near = near[ids[near] != query_ids[i]]
            if not len(near):
                continue
            if len(near) > 8 * k:  # the most promising first: they tighten the bound for the rest
                near = near[np.argsort(low[i, near], kind="stable")]
            for lo in range(0, len(near), 8 * k):
                part = near[lo:lo + 8 * k]
                part = part[~(low[i, part] > best_d[i, -1] ** 2 * (1 + 1e-9))]
                if not len(part):
                    continue
                d = np.concatenate([best_d[i], _true_distance(queries[i], vec[part])])
                j = np.concatenate([best_id[i], ids[part]])
                order = np.lexsort((j, d))[:k]
                best_d[i], best_id[i] = d[order], j[order]
    row, col = np.nonzero(best_id < np.iinfo(np.int64).max)
    return query_ids[row], best_id[row, col], best_d[row, col]


def nearest(vectors: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10,
            bound: float = BOUND) -> DataFrame:
    """The ``k`` nearest rows of every row where ``is_query`` (a condition on vec_id)
    holds: query_id, rank from 1, vec_id, score (Euclidean distance of the given vectors).

    Candidates are all usable rows with another id; ties go to the smaller id, fewer
    candidates give fewer rows.  Rows with a null id or vector, null or non-finite
    components, only zeros, or another length than the most common one take no
    part.  Repeated rows are candidates each; a repeated query id is searched once,
    with the smallest of its vectors.  Vectors of any finite size are ranked by their true
    distance (beyond the greatest double it is infinite).
    """
    spark = vectors.sparkSession
    rows = materialize(usable(vectors, id_col, vec_col), "vectors")
    dims, middle = centre(rows)
    schema = "query_id long, vec_id long, score double"
    parts = scratch_path(spark, "nearest-parts")
    spark.createDataFrame([], schema).write.parquet(parts)
    if dims:
        index = materialize(build_index(rows, dims, middle), "one-bit-index")
        asked = index.where(is_query).groupBy("vec_id").agg(F.min("vec").alias("vec"))
        blocks = materialize(asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(
            max(1, -(-asked.count() // QUERY_BLOCK))))), "queries")
        numbers = [r.block for r in blocks.select("block").distinct().collect()]
        # A block of queries has a bounded size and meets all rows: work is queries x rows, as asked
        # for.  One block at a time is with the driver and the tasks; its partial result is written.
        for number in sorted(numbers):
            block = blocks.where(F.col("block") == number).select("vec_id", "vec").orderBy("vec_id").collect()
            queries = np.array([r.vec for r in block])
            shared = spark.sparkContext.broadcast((np.array([r.vec_id for r in block]), queries, middle))

            def search(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
                ids, queries, middle = shared.value
                centred = queries - middle
                q_norm = np.sqrt((centred ** 2).sum(1))
                turned = ((centred / np.where(q_norm > 0, q_norm, 1)[:, None]) @ rotation(dims)).astype(np.float32)

                def parts():
                    for batch in batches:
                        for lo in range(0, batch.num_rows, CANDIDATE_BLOCK):
                            b = batch.slice(lo, CANDIDATE_BLOCK)
                            codes = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(b.num_rows, -1)
                            yield (b.column(0).to_numpy(), codes, b.column(2).to_numpy(), b.column(3).to_numpy(),
                                   _matrix(b.column(4), dims))

                q, v, s = search_block(ids, queries, turned, q_norm, parts(), dims, k, bound)
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s)],
                                                 ["query_id", "vec_id", "score"])

            index.mapInArrow(search, schema).write.mode("append").parquet(parts)
            shared.unpersist()
    found = spark.read.schema(schema).parquet(parts)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: the 10 nearest of every row of ``embeddings``
    whose vec_id is divisible by 100, among all other rows."""
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP6_SQL = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT * FROM v WHERE vec_id IS NOT NULL AND e IS NOT NULL AND len(e) > 0
      AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id,
             sqrt(list_reduce(list_prepend(0.0::DOUBLE, list_transform(range(1, len(q.e) + 1), lambda i: (q.e[i] - c.e[i]) * (q.e[i] - c.e[i]))),
                              lambda a, b: a + b)) AS score
      FROM u q JOIN u c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
