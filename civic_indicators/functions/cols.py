"""Column reference helpers for headers with spaces, dots, slashes or accents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quote(name: str) -> str:
    """Back-tick quote a column name so '.', ' ' and '/' are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quote(name))


def as_col(c) -> Column:
    """Accept a Column or a raw (unquoted) column name."""
    return c if isinstance(c, Column) else col(c)


def sql_string(value: str) -> str:
    """A Spark SQL string literal (quotes and backslashes escaped)."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
