"""Row-preserving cleaning operators (P1-P20). Each is one ``select`` or one
``filter``: narrow, no shuffle, pushed into the scan where Catalyst can."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from civic_indicators.functions.cols import as_col, col
from civic_indicators.functions.patterns import SENTINELS
from civic_indicators.functions.text import clean, empty_to_null as _empty, null_if_in


def _string_cols(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}


def replace_columns(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Replace/add many columns in one projection, keeping column order
    (new names are appended)."""
    if not exprs:
        return df
    return df.withColumns(dict(exprs))


def null_sentinels(df: DataFrame, values: Iterable[str] = SENTINELS,
                   cols: Sequence[str] | None = None) -> DataFrame:
    """Exact sentinel text ('nan') becomes null in every string column,
    and NaN becomes null in floating-point columns."""
    strings = _string_cols(df)
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}
    wanted = cols or df.columns
    exprs = {c: null_if_in(c, values) for c in wanted if c in strings}
    exprs.update({c: F.when(~F.isnan(col(c)), col(c)) for c in wanted if c in floats})
    return replace_columns(df, exprs)


def clean_text(df: DataFrame, cols: Sequence[str], lower: bool = False) -> DataFrame:
    """Cast to text and trim (optionally lower-case) the listed columns."""
    return replace_columns(df, {c: clean(c, lower) for c in cols if c in df.columns})


def lower_strings(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Lower-case string cells; other types are left alone."""
    strings = _string_cols(df)
    targets = [c for c in (cols or df.columns) if c in strings]
    return replace_columns(df, {c: F.lower(col(c)) for c in targets})


def null_values(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Listed values become null in one column."""
    return replace_columns(df, {column: null_if_in(column, values)})


def recode(df: DataFrame, column: str, mapping: Mapping[str, str]) -> DataFrame:
    """P5: exact-match dictionary recode; other values unchanged.

    A literal map lookup (one expression, no join) suits the short fixed
    dictionaries of the reports.
    """
    if not mapping:
        return df
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    c = col(column)
    return replace_columns(df, {column: F.coalesce(F.try_element_at(m, c), c)})


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Nulls replaced by a constant per column."""
    return replace_columns(df, {c: F.coalesce(col(c), F.lit(v)) for c, v in values.items()})


def empty_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P7: '' becomes null."""
    return replace_columns(df, {c: _empty(c) for c in cols})


def drop_empty(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows null in *all* of the subset columns."""
    return df.filter(F.coalesce(*[col(c) for c in subset]).isNotNull() if len(subset) > 1
                     else col(subset[0]).isNotNull())


def missing_any(*cols) -> Column:
    """Rows missing at least one of the columns (P13 reject rule)."""
    out = None
    for c in cols:
        p = as_col(c).isNull()
        out = p if out is None else (out | p)
    return out


def split_valid(df: DataFrame, rejected: Column) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected), complementary and null-safe: no row is lost."""
    r = F.coalesce(rejected, F.lit(False))
    return df.filter(~r), df.filter(r)


def where_equals(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Equality filter on several columns (pushed to the scan)."""
    cond = F.lit(True)
    for c, v in values.items():
        cond = cond & (col(c) == F.lit(v))
    return df.filter(cond)


def assign_where(df: DataFrame, column: str, mask: Column, value) -> DataFrame:
    """Set ``column`` to ``value`` where ``mask`` holds (null mask -> unchanged)."""
    base = col(column) if column in df.columns else F.lit(None).cast("string")
    expr = F.when(F.coalesce(mask, F.lit(False)), F.lit(value)).otherwise(base)
    return replace_columns(df, {column: expr})


def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Column subset."""
    return df.select(*[col(c) for c in cols])


def sort_by(df: DataFrame, *cols: str, ascending: bool = True) -> DataFrame:
    """Order rows by the given columns (a range-partitioned global sort)."""
    return df.orderBy(*[col(c).asc_nulls_last() if ascending else col(c).desc_nulls_last() for c in cols])
