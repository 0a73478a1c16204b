"""Named cohort predicates.

Predicates are plain comparisons so a filter on them reaches the Parquet
scan (PushedFilters); they are null where an input is null, which filters
and the conditional counts of a panel treat as "not in the cohort". Where a
year is known the month is a date range on the raw column (``period``);
cohorts without a year keep ``month(col) = m``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civic_indicators.functions.cols import as_col, col
from civic_indicators.functions.dates import period


def in_month(date_col, month: int, year: int | None = None) -> Column:
    """Month of a date column, optionally of a given year (Q10: year optional)."""
    if year is not None:
        return period(date_col, year, month)
    return F.month(as_col(date_col)) == F.lit(month)


def equals(column: str, value) -> Column:
    return col(column) == F.lit(value)


def month_number_is(column: str, month: int, year_column: str | None = None, year: int | None = None) -> Column:
    """(d)/(e): month/year kept as integer columns."""
    c = equals(column, month)
    return c & equals(year_column, year) if year_column and year is not None else c


def registration_cohort(date_col: str, channel_col: str, channel: str, type_col: str, kind: str,
                        month: int | None = None, year: int | None = None) -> Column:
    """(f): registrations of a channel and record type in a month."""
    base = equals(channel_col, channel) & equals(type_col, kind)
    return base & in_month(date_col, month, year) if month is not None else base


def placed(placed_col: str, month_col: str, month_name: str) -> Column:
    """(c): placed (= 1) in a month given by name."""
    return equals(placed_col, 1) & equals(month_col, month_name)


def present(column: str) -> Column:
    """(h): the label column holds a value."""
    return col(column).isNotNull()


def with_counsellor(month_col: str, month: int, year_col: str, year: int, counsellor_col: str) -> Column:
    """(i): guided in a month by a named counsellor."""
    return month_number_is(month_col, month, year_col, year) & present(counsellor_col)


def until(column: str, cutoff) -> Column:
    """P20: on or before a cut-off (a date, or yyyy-MM-dd text on a text column)."""
    return col(column) <= F.lit(cutoff)


def age_group(age, lo=None, hi=None, hi_inclusive: bool = False, min_age=None) -> Column:
    """Guarded numeric range on ages (elders >= 60, adults 29-59, youth <= 28)."""
    from civic_indicators.operators.aggregate import age_predicate
    return age_predicate(age, lo, hi, hi_inclusive, min_age)


def any_population(*label_cols: str) -> Column:
    """(g): at least one population label present."""
    from civic_indicators.functions.classify import any_flag
    return any_flag(*label_cols)


# The named cohorts of the reports, by name -> builder.
COHORTS = {
    "vacancy_month": lambda column, month_name: equals(column, month_name),                  # (a)
    "sent": lambda date_col, month, year=None: in_month(date_col, month, year),              # (b)
    "placed": placed,                                                                        # (c)
    "guided": month_number_is,                                                               # (d)
    "workshop": month_number_is,                                                             # (e)
    "registration": registration_cohort,                                                     # (f)
    "any_population": any_population,                                                        # (g)
    "has_label": present,                                                                    # (h)
    "with_counsellor": with_counsellor,                                                      # (i)
}


def cohort(name: str, *args, **params) -> Column:
    """A named cohort predicate, e.g. ``cohort("sent", "fecha_envio", 4)``."""
    return COHORTS[name](*args, **params)
