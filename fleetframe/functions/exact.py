"""Order-independent sums, means and deviations of fixed-scale values.

Trip measures are stored rounded (2 or 4 decimals).  A floating-point mean of
such values lands exactly on a rounding edge surprisingly often (the mean of
0.16 and 0.17 is 0.165), and which way it then rounds depends on summation
order, i.e. on how rows were partitioned.  Here each value becomes an exact
integer count of units (``round(x * 10^scale)``), sums of units are exact
integer arithmetic in any order, and the final rounding is integer HALF_UP.
The results are identical for every partitioning of the input.

Builders come in two halves so they work for ``groupBy().agg()`` and for
window frames alike: ``unit_aggs`` gives the aggregate expressions, the
``*_of`` functions turn their results into values.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from fleetframe.functions.numeric import _c

#: Type of every sum of units.
WIDE = "decimal(38,0)"


def units(x, scale: int) -> Column:
    """Exact integer units of a value that is already rounded to ``scale`` decimals.

    A value beyond the range of a long (an efficiency over a near-zero energy sum)
    has no units: it is left out of means and deviations, its row stays."""
    return F.round(_c(x) * (10 ** scale)).try_cast("long")


def _halves(u: Column) -> tuple[Column, Column]:
    """A long as ``high * 2^32 + low`` with the low part from -2^31 on (two columns)."""
    carry = F.shiftright(u, 31).bitwiseAND(F.lit(1))
    return F.shiftright(u, 32) + carry, u.bitwiseAND(F.lit(0xFFFFFFFF)) - carry * F.lit(1 << 32)


def _square_values(u: Column) -> dict[str, Column]:
    """Per-row longs whose sums give the sum of squares of units: the high half, and the
    products of both halves (each below 2^62, so that any long can be squared)."""
    high, low = _halves(u)
    return {"h": high, "hh": high * high, "hl": high * low, "ll": low * low}


#: Names of the parts of a sum of squares.
SQUARE_PARTS = ("h", "hh", "hl", "ll")


def unit_aggs(x, scale: int, *, squares: bool = False) -> dict[str, Column]:
    """Aggregate expressions: unit sum ``s``, count ``n`` and, with ``squares``, ``q``, a
    struct of the parts of the sum of squares.  All sums are decimal(38,0): a group of
    10^19 rows of any long cannot overflow them, and they merge by adding."""
    u = units(x, scale)
    out = {"s": F.sum(u.cast(WIDE)), "n": F.count(u)}
    if squares:
        out["q"] = F.struct(*[F.sum(v.cast(WIDE)).alias(k) for k, v in _square_values(u).items()])
    return out


def unit_values(x, scale: int, *, squares: bool = False) -> dict[str, Column]:
    """Per-row values whose sums give ``unit_aggs``: units, a 0/1 presence flag
    and (optionally) the parts of the squares."""
    u = units(x, scale)
    out = {"s": u, "n": F.when(u.isNotNull(), F.lit(1)).otherwise(F.lit(0))}
    if squares:
        out.update(_square_values(u))
    return out


def sum_of(s: Column, scale: int) -> Column:
    """The exact sum as the nearest double."""
    return s.cast("double") / float(10 ** scale)


def mean_of(s: Column, n: Column, scale: int) -> Column:
    """The exact mean as the nearest double (NULL for no values)."""
    d = n * (10 ** scale)
    return F.when(n > 0, s.cast("double") / d.cast("double"))


def rounded_mean_of(s: Column, n: Column, scale: int, digits: int) -> Column:
    """The exact mean rounded HALF_UP (away from zero) to ``digits`` decimals."""
    d = n.cast(WIDE) * F.lit(10 ** scale).cast("decimal(10,0)")
    scaled = F.abs(s.cast(WIDE)) * F.lit(2 * 10 ** digits).cast("decimal(10,0)") + d
    q = F.call_function("div", scaled, d * F.lit(2).cast("decimal(1,0)"))
    return F.when(n > 0, F.when(s < 0, -q).otherwise(q) / float(10 ** digits))


def _number(value: int) -> Column:
    return F.lit(Decimal(value))


def _nearest_mean(s: Column, n: Column) -> Column:
    """The mean in units, rounded to a whole number (a long; 0 of no values)."""
    n = F.greatest(n, _number(1).cast(WIDE))
    half = F.call_function("div", F.abs(s) * _number(2) + n, n * _number(2))
    return F.when(s < 0, -half).otherwise(half)


def _around(mean: Column, s: Column, q: Column, n: Column) -> dict[str, Column]:
    """Sums of the halves' products around ``mean``, and what it leaves of the sum."""
    h, hh, hl, ll = (q.getField(k).cast(WIDE) for k in SQUARE_PARTS)
    low = s - h * _number(1 << 32)
    mean_h, mean_l = (v.cast(WIDE) for v in _halves(mean))
    return {"hh": hh - _number(2) * mean_h * h + n * mean_h * mean_h,
            "hl": hl - mean_h * low - mean_l * h + n * mean_h * mean_l,
            "ll": ll - _number(2) * mean_l * low + n * mean_l * mean_l,
            "rest": s - mean.cast(WIDE) * n}  # at most n / 2 to either side


def _rough(around: dict[str, Column]) -> Column:
    return (around["hh"].cast("double") * float(1 << 64) + around["hl"].cast("double") * float(1 << 33)
            + around["ll"].cast("double"))


def _deviation(around: dict[str, Column], rough: Column, n: Column, scale: int) -> Column:
    rows, rest = n.cast("double"), around["rest"]
    exact = around["hh"] * _number(1 << 64) + around["hl"] * _number(1 << 33) + around["ll"]
    variance = F.when(rough * rows < 9e37, (exact * n - rest * rest).cast("double") / (rows * (rows - 1))) \
        .otherwise((rough - rest.cast("double") * rest.cast("double") / rows) / (rows - 1))
    return F.when(n > 1, F.sqrt(variance) / float(10 ** scale))


def stddev_of(s: Column, q: Column, n: Column, scale: int) -> Column:
    """Sample standard deviation from the sums of ``unit_aggs`` (NULL below two values);
    ``q`` is a struct of the square parts.

    The squares are taken around the nearest whole mean, half by half, before they are
    put together, so nothing overflows: the halves' sums stay below rows x 2^64.  Where
    the result fits 38 digits it is exact up to its last division, else (a spread that
    no measure but a broken one has) it is added up in doubles, whose terms then have
    nothing left to cancel.
    """
    n, s = n.cast(WIDE), s.cast(WIDE)
    around = _around(_nearest_mean(s, n), s, q, n)
    return _deviation(around, _rough(around), n, scale)


def with_stddev(df: DataFrame, name: str, s: Column, q: Column, n: Column, scale: int) -> DataFrame:
    """``df`` with ``stddev_of`` as column ``name``, in steps: as one expression beside others
    its generated code may be too long to compile."""
    mean, rough, parts = f"__{name}_mean", f"__{name}_rough", {k: f"__{name}_{k}" for k in ("hh", "hl", "ll", "rest")}
    n, s = n.cast(WIDE), s.cast(WIDE)
    around = {k: F.col(c) for k, c in parts.items()}
    out = df.withColumn(mean, _nearest_mean(s, n))
    out = out.withColumns({parts[k]: c for k, c in _around(F.col(mean), s, q, n).items()})
    out = out.withColumn(rough, _rough(around))
    return out.withColumn(name, _deviation(around, F.col(rough), n, scale)).drop(mean, rough, *parts.values())


def out_of_range(x, scale: int) -> Column:
    """Whether a value is there but has no units: what means leave out, for counting."""
    x = _c(x)
    return x.isNotNull() & units(x, scale).isNull()
