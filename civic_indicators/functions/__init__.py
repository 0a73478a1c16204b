"""Column-level building blocks (no DataFrame in, Column out)."""

from civic_indicators.functions.classify import any_flag, any_of, flag, label_last_match, labels_all
from civic_indicators.functions.cols import as_col, col, quote
from civic_indicators.functions.dates import (
    day_from_text, day_text, iso_week, iso_year, latest, month_of, parse_mixed_date, period, stamp, stamp_date, unparsed,
    to_day, to_ts, to_ts_or_null, year_of,
)
from civic_indicators.functions.numbers import (
    band, between, digits_or_null, integral_or_null, round_half_even, to_number,
)
from civic_indicators.functions.text import (
    append_text, clean, concat_present, empty_to_null, matches, null_if_in, strip,
)

__all__ = [
    "any_flag", "any_of", "flag", "label_last_match", "labels_all",
    "as_col", "col", "quote",
    "day_from_text", "day_text", "iso_week", "iso_year", "latest", "month_of", "parse_mixed_date", "period", "unparsed",
    "stamp", "stamp_date", "to_day", "to_ts", "to_ts_or_null", "year_of",
    "band", "between", "digits_or_null", "integral_or_null", "round_half_even", "to_number",
    "append_text", "clean", "concat_present", "empty_to_null", "matches", "null_if_in", "strip",
]
