"""Numeric column builders (all JVM-side expressions, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean_numeric(x) -> Column:
    """Text or number -> double; NULL for NaN (any case), blanks and junk.

    One rule for every measure, applied once at the read boundary, so a
    missing value can neither poison sums/averages (NaN) nor pass an
    ``IS NOT NULL`` presence test.
    """
    as_double = F.trim(_c(x).cast("string")).try_cast("double")
    return F.when(~F.isnan(as_double), as_double)


def missing_text(text: Column) -> Column:
    """Whether trimmed text stands for no value: NULL, blank or NaN in any case and sign."""
    return text.isNull() | (text == "") | F.coalesce(F.isnan(text.try_cast("double")), F.lit(False))


def guarded_ratio(num, den, scale: int) -> Column:
    """round(num / den, scale) when den > 0, else 0 (also 0 for a NULL den).

    A NULL numerator with a positive denominator stays NULL.
    """
    num, den = _c(num), _c(den)
    return F.round(F.when(den > 0, num / den).otherwise(F.lit(0)), scale)


def safe_ratio(num, den) -> Column:
    """num / den, NULL when den is zero or NULL (no ANSI divide error)."""
    return F.try_divide(_c(num), _c(den))
