"""Date and time Column builders.

The mixed-format parser (D3) runs as one chain of ``try_to_timestamp`` calls,
so it stays inside whole-stage code generation and never raises under ANSI
mode; only the strict parser (D1) raises on a bad value.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from civic_indicators.functions.cols import as_col
from civic_indicators.functions.patterns import EXCEL_MAX_SERIAL, EXCEL_ORIGIN
from civic_indicators.functions.text import strip

# Day-first guesses tried after the strict dd-mm-yyyy form, on the text with
# '/' and '.' separators turned into '-'. Each format runs only on text of its
# own shape (a cheap regex test): a failed parse costs an exception inside the
# JVM, so trying every format on every cell would dominate the flow's time.
# The month-first form only catches what cannot be day-first (03/25/2025).
_TIME = "[ H:mm[:ss]]"
_TIME_RE = "( [0-9]{1,2}:[0-9]{2}(:[0-9]{2})?)?$"
_NOON_RE = " [0-9]{1,2}:[0-9]{2}(:[0-9]{2})? [AP]M$"
_DMY_RE = "^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}"
_DMYY_RE = "^[0-9]{1,2}-[0-9]{1,2}-[0-9]{2}"
_YMD_RE = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
DAYFIRST_FORMATS = (
    (_DMY_RE + _TIME_RE, "d-M-yyyy" + _TIME),
    (_YMD_RE + _TIME_RE, "yyyy-M-d" + _TIME),
    (_YMD_RE + "T[0-9]{1,2}:[0-9]{2}(:[0-9]{2})?$", "yyyy-M-d'T'H:mm[:ss]"),
    (_DMY_RE + _TIME_RE, "M-d-yyyy" + _TIME),
    (_DMYY_RE + _TIME_RE, "d-M-yy" + _TIME),
    (_DMYY_RE + _TIME_RE, "M-d-yy" + _TIME),
    (_DMY_RE + _NOON_RE, "d-M-yyyy h:mm[:ss] a"),
    (_DMY_RE + _NOON_RE, "M-d-yyyy h:mm[:ss] a"),
    (_YMD_RE + _NOON_RE, "yyyy-M-d h:mm[:ss] a"),
)
ISO_DAYFIRST_FORMATS = ((_YMD_RE + _TIME_RE, "yyyy-d-M" + _TIME), (_YMD_RE + _NOON_RE, "yyyy-d-M h:mm[:ss] a"))
# Written out: 03-feb-2025, 3 de febrero de 2025, 3 Jan 2025 (first three letters, Spanish or English).
_NAMED_RE = "^([0-9]{1,2})[- /.]+(?:de )?([a-z]{3})[a-z]*[- /.]+(?:del? )?([0-9]{4})(.*)$"
_MONTHS_ES = "ene feb mar abr may jun jul ago sep oct nov dic"
_MONTHS_EN = "jan feb mar apr may jun jul aug sep oct nov dec"


def _century(ts: Column, fmt: str) -> Column:
    """Two-digit years 69 to 99 are those of the 1900s."""
    if "yyyy" in fmt:
        return ts
    return F.when(F.year(ts) >= 2069, ts - F.expr("INTERVAL 100 YEARS")).otherwise(ts)


def _canonical(s: Column) -> Column:
    """The text with month names as numbers, AM/PM marks as ' AM'/' PM' and without fractions of a second."""
    low = F.lower(s)
    three = F.regexp_extract(low, _NAMED_RE, 2)
    at = F.greatest(F.instr(F.lit(_MONTHS_ES), three), F.instr(F.lit(_MONTHS_EN), three))
    named = F.concat(F.regexp_extract(low, _NAMED_RE, 1), F.lit("-"), F.floor((at + 3) / 4).cast("string"), F.lit("-"),
                     F.regexp_extract(low, _NAMED_RE, 3), F.regexp_extract(low, _NAMED_RE, 4))
    s = F.when(low.rlike(_NAMED_RE) & (at > 0), named).otherwise(s)
    s = F.when(s.rlike(":[0-9]{2}[.][0-9]+"), F.regexp_replace(s, "(:[0-9]{2})[.][0-9]+", "$1")).otherwise(s)
    return F.when(s.rlike("(?i)[ap][.]? ?m[.]?$"), F.regexp_replace(F.upper(s), " *([AP])[.]? ?M[.]?$", " $1M")).otherwise(s)


def to_ts(c, fmt: str | None = None) -> Column:
    """Strict parse; a bad value fails the job (ANSI)."""
    return F.to_timestamp(as_col(c), fmt) if fmt else F.to_timestamp(as_col(c))


def to_ts_or_null(c, fmt: str | None = None) -> Column:
    """Lenient parse; a bad value becomes null.

    Without a format: ISO text first, then slash/dot/dash dates month-first
    (03/04/2025 is 4 March), day-first only when that is the only reading
    (25/03/2025), each format tried only on text of its shape.
    """
    c = as_col(c)
    if fmt:
        return F.try_to_timestamp(c, F.lit(fmt))
    s = c.cast("string")
    dashed = F.translate(s, "/.", "--")
    shape = dashed.rlike(_DMY_RE + _TIME_RE)
    return F.coalesce(F.try_to_timestamp(s),
                      F.when(shape, F.try_to_timestamp(dashed, F.lit("M-d-yyyy" + _TIME))),
                      F.when(shape, F.try_to_timestamp(dashed, F.lit("d-M-yyyy" + _TIME))))


def excel_serial(s) -> Column:
    """Day number counted from 1899-12-30 -> timestamp; out of range -> null."""
    n = as_col(s).try_cast("int")
    day = F.date_add(F.lit(EXCEL_ORIGIN).cast("date"), n)
    return F.when((n >= 0) & (n <= EXCEL_MAX_SERIAL), day.cast("timestamp"))


def parse_mixed_date(c, iso_dayfirst: bool = False, trimmed: bool = False) -> Column:
    """D3: null/'' -> null; all digits -> Excel serial; dd-mm-yyyy; then day-first guesses.

    ``iso_dayfirst=True`` reads yyyy-aa-bb as year-day-month, the way a
    day-first guesser treats ISO text. ``trimmed=True`` skips the white-space
    strip when the caller projected a trimmed column already (keeps the
    generated code small: the text is referenced by every format).
    """
    formats = list(DAYFIRST_FORMATS)
    if iso_dayfirst:
        formats = [f for f in formats if not f[1].startswith("yyyy")]
        formats = list(ISO_DAYFIRST_FORMATS) + formats
    s = as_col(c).cast("string")
    if not trimmed:
        s = strip(s)
    strict = F.when(s.rlike(_DMY_RE + "$"), F.try_to_timestamp(s, F.lit("d-M-yyyy")))

    def guesses(text: Column) -> list[Column]:
        dashed = F.translate(text, "/.", "--")
        return [F.when(dashed.rlike(shape), _century(F.try_to_timestamp(dashed, F.lit(f)), f)) for shape, f in formats]

    # Letters or a fraction of a second: rewritten first (a lambda, so the text is rewritten once).
    written = F.element_at(F.transform(F.array(_canonical(s)), lambda t: F.coalesce(*guesses(t))), 1)
    return (F.when(s.isNull() | (s == ""), F.lit(None).cast("timestamp"))
            .when(s.rlike("^[0-9]+$"), excel_serial(s))
            .when(s.rlike("[A-SU-Za-z]|:[0-9]{2}[.]"), written)
            .otherwise(F.coalesce(strict, *guesses(s))))


def unparsed(c, iso_dayfirst: bool = False) -> Column:
    """Whether a cell holds text that ``parse_mixed_date`` does not read (to be counted and looked at)."""
    s = strip(as_col(c).cast("string"))
    return F.coalesce(s != "", F.lit(False)) & parse_mixed_date(s, iso_dayfirst, trimmed=True).isNull()


def latest(*cols) -> Column:
    """Latest non-null value of the row."""
    return F.greatest(*[as_col(c) for c in cols])


def to_day(c) -> Column:
    """Floor to the day."""
    return F.to_date(as_col(c))


def day_text(c) -> Column:
    """Yyyy-MM-dd text."""
    return F.date_format(as_col(c), "yyyy-MM-dd")


def day_from_text(c) -> Column:
    """A yyyy-MM-dd text back to a date (null if it is not one)."""
    return F.try_to_timestamp(as_col(c), F.lit("yyyy-MM-dd")).cast("date")


def month_of(c) -> Column:
    return F.month(as_col(c))


def year_of(c) -> Column:
    return F.year(as_col(c))


def iso_week(c) -> Column:
    """ISO-8601 week number (2024-12-30 -> 1)."""
    return F.weekofyear(as_col(c))


def iso_year(c) -> Column:
    """ISO-8601 week-based year (2024-12-30 -> 2025)."""
    return F.extract(F.lit("YEAROFWEEK"), as_col(c))


def stamp_date(run_date: str | _dt.date | None = None) -> Column:
    """The run date, or today."""
    if run_date is None:
        return F.current_date()
    return F.lit(str(run_date)).cast("date")


def stamp(df, run_date: str | _dt.date | None = None, column: str = "run_date"):
    """The run date as a column of ``df``."""
    return df.withColumn(column, stamp_date(run_date))


def period(c, year: int, month: int | None = None) -> Column:
    """A calendar month (or year) as a half-open range on the raw column.

    Unlike ``month(c) = m`` this is a plain comparison, so Parquet row groups
    outside the range are skipped (PushedFilters). It is null for a null
    date: a filter or a conditional count treats that as "not in"; wrap it
    in ``coalesce(..., False)`` before negating.
    """
    if month is None:
        start, end = _dt.date(year, 1, 1), _dt.date(year + 1, 1, 1)
    else:
        start = _dt.date(year, month, 1)
        end = _dt.date(year + (month == 12), month % 12 + 1, 1)
    c = as_col(c)
    return (c >= F.lit(start)) & (c < F.lit(end))
