"""Row order that keeps several columns in narrow ranges at once.

Every column is cut into 2^BITS ranges of about as many rows each (approximate quantiles,
one aggregate over the rows).  The bits of a row's range numbers, taken in turn from each
column, make its place on a curve through all combinations; rows are range-partitioned
and sorted by that place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Ranges of a column: 2^BITS.
BITS = 5


def _number(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    return F.unix_date(column) if isinstance(kind, T.DateType) else F.col(column)


def range_bounds(df: DataFrame, columns) -> dict[str, list]:
    """Upper bounds of the ranges of every column (fewer where values repeat)."""
    shares = [k / (1 << BITS) for k in range(1, 1 << BITS)]
    row = df.agg(*[F.percentile_approx(_number(df, c), shares, 10_000).alias(c) for c in columns]).first()
    return {c: sorted(set(row[c] or [])) for c in columns}


def curve_place(df: DataFrame, bounds: dict[str, list]) -> Column:
    """Interleaved bits of the range numbers, the first column's first; NULL is in the lowest range."""
    place = F.lit(0)
    for j, (column, limits) in enumerate(bounds.items()):
        value = _number(df, column)
        number = reduce(lambda a, b: a + b, [F.when(value > F.lit(x), 1).otherwise(0) for x in limits], F.lit(0))
        for bit in range(BITS):
            to = bit * len(bounds) + (len(bounds) - 1 - j)
            place = place + F.shiftleft(F.shiftright(number, bit).bitwiseAND(F.lit(1)), to)
    return place


def clustered(df: DataFrame, columns) -> DataFrame:
    """``df`` range-partitioned and sorted along the curve of ``columns``."""
    place = "__curve_place"
    placed = df.withColumn(place, curve_place(df, range_bounds(df, columns)))
    return placed.repartitionByRange(place, *columns).sortWithinPartitions(place, *columns).drop(place)
