"""Numeric coercion, rounding, bands and range predicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from civic_indicators.functions.cols import as_col
from civic_indicators.functions.patterns import AGE_BANDS


def to_number(c) -> Column:
    """Number or null; unparsable text and NaN ('nan' parses to NaN) give null."""
    x = as_col(c).try_cast("double")
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def text_number(c) -> Column:
    """P8 for a text column: text without a digit and without 'inf' is no number, and is not parsed
    (a failed parse costs an exception)."""
    c = as_col(c)
    return to_number(F.when(c.rlike("[0-9]|[iI][nN][fF]"), c))


def round_half_even(c) -> Column:
    """P10: banker's rounding to a nullable int (2.5 -> 2, 3.5 -> 4); no int, no value."""
    return F.bround(to_number(c), 0).try_cast("int")


def digits_or_null(c, fill: int | None = 0) -> Column:
    """P6+P9: missing -> ``fill``; kept (as int) only when the text is all ASCII digits."""
    s = as_col(c).cast("string")
    if fill is not None:
        s = F.coalesce(s, F.lit(str(fill)))
    return F.when(s.rlike("^[0-9]+$"), s.try_cast("int"))


def integral_or_null(c, fill: int | None = 0) -> Column:
    """Numeric variant of P9: whole numbers kept as int, others null (25.0 -> 25)."""
    x = as_col(c).cast("double")
    if fill is not None:
        x = F.coalesce(x, F.lit(float(fill)))
    return F.when((x >= 0) & (x == F.floor(x)), x.try_cast("int"))


def between(c, lo=None, hi=None, lo_inclusive: bool = True, hi_inclusive: bool = False) -> Column:
    """Range predicate with optional bounds; null compares as false."""
    c = as_col(c)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & ((c >= lo) if lo_inclusive else (c > lo))
    if hi is not None:
        cond = cond & ((c <= hi) if hi_inclusive else (c < hi))
    return F.coalesce(cond, F.lit(False))


def band(c, bands: Sequence[tuple] = AGE_BANDS) -> Column:
    """Label of the first band holding the value, else null.

    ``bands`` are ``(low, high, label, low_inclusive)`` with an exclusive high.
    """
    out = None
    for lo, hi, label, lo_inc in bands:
        cond = between(c, lo, hi, lo_inclusive=lo_inc)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out
