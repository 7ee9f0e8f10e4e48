"""Principal components and whitened coordinates by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows X are never gathered.  One job of a step multiplies them with a vector
and their transpose with the result (X z, then its products with the rows, added up in
the tasks).  A left vector u of the process is kept as the combination y with u = X y,
so its products with all earlier left vectors follow from numbers of one row's width:
u_i . X z = y_i . Xt X z.  Left and right vectors are orthogonalised against all earlier
ones.  The singular vectors and values of the small bidiagonal matrix give components and
deviations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetframe.llm.common import materialize, read_table

SCALE, COMPONENTS = 256, 4
#: Steps before convergence is looked at: up to so many dimensions the basis is complete.
FIRST_CHECK = 64
#: Residuals that count as none, and lengths of products that do, as shares of the greatest.
CONVERGED, ZERO = 1e-14, 1e-10


def integer_rows(vectors: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """Rows (vec_id, x): floor(scale * component) of the vectors whose components are all there and finite."""
    vec = F.col("vec")
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec")) \
        .where(vec.isNotNull() & (F.size(vec) > 0) & F.forall(
            vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * scale) < F.lit(2.0 ** 62)))) \
        .select("vec_id", F.transform(vec, lambda c: F.floor(c * scale).cast("long")).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False)
    return x.reshape(len(column), -1)


def added(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum over all rows of ``part`` (``size`` doubles for a block of rows): each task adds
    up its own, then Spark adds the tasks' numbers by place."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += part(_matrix(batch.column(0)))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["i", "v"])

    out = np.zeros(size)
    for r in rows.select("x").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r.i] = r.v  # `size` rows
    return out


def exact_sums(rows: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of rows and the sum of each dimension, exact: both halves of a number are added apart."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low, n = np.zeros(dims, np.int64), np.zeros(dims, np.int64), 0
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                high, low, n = high + (x >> 32).sum(0), low + (x & 0xFFFFFFFF).sum(0), n + len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims, dtype=np.int32)), pa.array(high), pa.array(low),
                                          pa.array(np.full(dims, n))], ["i", "high", "low", "n"])

    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    out = rows.select("x").mapInArrow(run, "i int, high long, low long, n long").groupBy("i") \
        .agg(wide("high"), wide("low"), wide("n")).orderBy("i").collect()  # one row for each dimension
    return int(out[0].n), [(int(r.high) << 32) + int(r.low) for r in out]


class Bidiagonal:
    """Golub-Kahan-Lanczos process for centred rows that only ``gram`` reaches:
    gram(z) = (Xt X z, |X z|^2) for a vector z.  ``size`` is the Frobenius norm of X."""

    def __init__(self, gram: Callable[[np.ndarray], tuple[np.ndarray, float]], dims: int, size: float, seed: int = 23):
        self.gram, self.dims, self.size = gram, dims, size
        self.random = np.random.default_rng(seed)
        self.right = np.zeros((dims, 0))  # v
        self.left = np.zeros((dims, 0))  # y, with u = X y
        self.back = np.zeros((dims, 0))  # Xt u
        self.alpha: list[float] = []
        self.beta: list[float] = []

    def _orthogonal(self, v: np.ndarray, *others: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for basis in (self.right, *others):
                v = v - basis @ (basis.T @ v)
        return v

    def _fresh(self, *others: np.ndarray) -> np.ndarray | None:
        """A unit vector orthogonal to all right vectors so far, if there is one."""
        if self.right.shape[1] + sum(o.shape[1] for o in others) >= self.dims:
            return None
        for _ in range(8):
            v = self._orthogonal(self.random.normal(size=self.dims), *others)
            if (length := np.linalg.norm(v)) > 1e-6:
                return self._orthogonal(v / length, *others)
        return None

    def triplets(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Singular values, right singular vectors and residuals so far."""
        k = len(self.alpha)
        b = np.diag(self.alpha) + np.diag(self.beta[:k - 1], 1)
        p, s, q = np.linalg.svd(b)
        return s, self.right[:, :k] @ q.T, np.abs(self.beta[k - 1] * p[-1]) if k else s

    def run(self, wanted: int, outside: np.ndarray) -> None:
        """Steps until ``wanted`` triplets have converged or no direction is left.  The
        columns of ``outside`` are kept out of all vectors."""
        v, tail = self._fresh(outside), 0.0
        while v is not None:
            step = len(self.alpha)
            self.right = np.column_stack([self.right, v])
            z = v - tail * self.left[:, -1] if step else v
            g, square = self.gram(z)  # X z and Xt (X z)
            c = self.left.T @ g  # products of X z with all left vectors
            z, g = z - self.left @ c, g - self.back @ c
            square -= float(c @ c)
            if square <= (ZERO * self.size) ** 2:  # v leads nowhere new
                alpha, y, back = 0.0, np.zeros(self.dims), np.zeros(self.dims)
            else:
                alpha = np.sqrt(square)
                y, back = z / alpha, g / alpha
            self.left, self.back = np.column_stack([self.left, y]), np.column_stack([self.back, back])
            self.alpha.append(float(alpha))
            v = self._orthogonal(back - alpha * v, outside)
            tail = float(np.linalg.norm(v))
            if tail <= CONVERGED * self.size:
                v, tail = self._fresh(outside), 0.0
            else:
                v = self._orthogonal(v / tail, outside)
                v /= np.linalg.norm(v)
            if self.right.shape[1] + outside.shape[1] >= self.dims:
                v, tail = None, 0.0
            self.beta.append(tail)
            if v is not None and len(self.alpha) >= max(FIRST_CHECK, wanted):
                s, _, residual = self.triplets()
                if (residual[:wanted] <= CONVERGED * s[0]).all():
                    return


def components(gram, dims: int, size: float, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` greatest singular values (zeros left out) and their right singular
    vectors.  A process that stopped early cannot see a second direction of an equal
    value, so the rest is searched until nothing greater than the least one is found."""
    process = Bidiagonal(gram, dims, size)
    process.run(wanted, np.zeros((dims, 0)))
    s, v, _ = process.triplets()
    s, v = s[:wanted], v[:, :wanted]
    complete = len(process.alpha) >= dims
    while not complete:
        rest = Bidiagonal(gram, dims, size, seed=29)
        rest.run(1, v)
        if not rest.alpha:
            break
        more, vectors, _ = rest.triplets()
        if len(s) == wanted and more[0] <= s[-1] * (1 + 1e-9):
            break
        order = np.argsort(-np.concatenate([s, more[:1]]), kind="stable")[:wanted]
        s, v = np.concatenate([s, more[:1]])[order], np.column_stack([v, vectors[:, :1]])[:, order]
    real = s > ZERO * size
    return s[real], v[:, real]


def squared_deviations(x: np.ndarray, n: int, sums: list[int]) -> list[Decimal | None]:
    """Sum over the dimensions of (n * x - sum)^2, exact; None beyond 38 digits."""
    top = n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, sums))
    if top ** 2 * x.shape[1] < 1 << 62:
        y = n * x - np.array(sums, np.int64)
        out = (y * y).sum(1).tolist()
    elif top < 1 << 52 and x.shape[1] < 1 << 10:
        y = n * x - np.array(sums, np.int64)
        high, low = y >> 26, y & ((1 << 26) - 1)
        out = [(a << 52) + (b << 27) + c for a, b, c in zip(
            *(k.sum(1).tolist() for k in (high * high, high * low, low * low)))]
    else:
        out = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x.tolist()]
    return [Decimal(v) if v < 10 ** 38 else None for v in out]


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", wanted: int = COMPONENTS,
           scale: int = SCALE) -> DataFrame:
    """vec_id, component, n, deviation (decimal), whitened, explained, identity_error of
    every usable row and each of the ``wanted`` greatest components.

    Usable rows have a vector without null or non-finite components, of the most common
    length (the smaller one if tied), whose ``scale``-fold components fit a long; others,
    null and empty vectors take no part.  Components are fitted on each different integer
    vector once.  Repeated rows are given each, a null id stays null.  Directions without
    deviation are no components, so few or equal vectors give fewer components, down
    to none and no row.  Equal eigenvalues have any orthogonal directions of their space.
    ``deviation`` is null beyond 38 digits.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
                                      "explained double, identity_error double")
    rows = materialize(integer_rows(vectors, id_col, vec_col, scale), "integer-vectors")
    common = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common is None:
        return empty
    dims = common.d
    rows = rows.where(F.size("x") == dims)
    fit = materialize(rows.select("x").distinct(), "fit-list")
    n, sums = exact_sums(fit, dims)
    mean = np.array([s / n for s in sums])

    def product(z: np.ndarray) -> tuple[np.ndarray, float]:
        def part(x: np.ndarray) -> np.ndarray:
            x = x - mean
            u = x @ z
            return np.concatenate([x.T @ u, [u @ u]])

        out = added(fit, part, dims + 1)
        return out[:-1], float(out[-1])

    squares = float(added(fit, lambda x: np.array([((x - mean) ** 2).sum()]), 1)[0])
    values, directions = components(product, dims, np.sqrt(squares), min(wanted, dims)) if squares else ([], [])
    k = len(values)
    if not k:
        return empty
    project = directions / (values / np.sqrt(n))

    def products(x: np.ndarray) -> np.ndarray:
        w = (x - mean) @ project
        return np.concatenate([(w.T @ w).ravel(), w.sum(0)])

    moments = added(fit, products, k * k + k) / n
    error = float(np.abs(moments[:k * k].reshape(k, k) - np.outer(moments[k * k:], moments[k * k:]) - np.eye(k)).max())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            at = pa.array(np.repeat(np.arange(len(x)), k))
            deviation = pa.array(squared_deviations(x, n, sums), pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 deviation.take(at), pa.array(((x - mean) @ project).ravel())],
                ["vec_id", "component", "deviation", "whitened"])

    out = rows.mapInArrow(run, "vec_id long, component int, deviation decimal(38,0), whitened double")
    share = F.element_at(F.array(*[F.lit(float(v * v / squares)) for v in values]), F.col("component"))
    return out.select("vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                      share.alias("explained"), F.lit(error).alias("identity_error"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every usable row
    of ``embeddings`` and the 4 greatest components (a deviation beyond a long is null)."""
    out = whiten(read_table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))
