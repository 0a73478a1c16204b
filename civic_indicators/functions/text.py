"""Text Column builders (all JVM-side built-ins)."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from civic_indicators.functions.cols import as_col

# Characters Python's ``str.strip`` removes (Unicode white space plus the
# ASCII separators 0x1c-0x1f). Spark's ``trim`` only removes U+0020.
WHITESPACE_CLASS = (
    r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
_EDGE_SPACE = f"^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$"
# The same set as characters, for ``trim`` (no regular expression needed).
WHITESPACE_CHARS = "".join(
    [chr(x) for x in range(0x09, 0x0E)] + [chr(x) for x in range(0x1C, 0x21)]
    + ["\x85", "\xa0", "\u1680"] + [chr(x) for x in range(0x2000, 0x200B)]
    + ["\u2028", "\u2029", "\u202f", "\u205f", "\u3000"])


def strip(c) -> Column:
    """Remove leading and trailing white space of every Unicode kind."""
    return F.trim(as_col(c), F.lit(WHITESPACE_CHARS))


def clean(c, lower: bool = False) -> Column:
    """Text form of a cell, trimmed and optionally lower-cased; null stays null."""
    s = as_col(c).cast("string")
    if lower:
        s = F.lower(s)
    return strip(s)


def null_if_in(c, values: Iterable[str]) -> Column:
    """Exact values become null, everything else is unchanged."""
    c = as_col(c)
    vals = list(values)
    if not vals:
        return c
    return F.when(c.isin(vals), F.lit(None)).otherwise(c)


def empty_to_null(c) -> Column:
    """P7: '' becomes null."""
    return F.nullif(as_col(c), F.lit(""))


def regex(pattern: str, ignore_case: bool = False) -> str:
    """Java regex for a report pattern; case folding is Unicode-aware (Í ~ í)."""
    return ("(?iu)" if ignore_case else "") + pattern


_REGEX_META = set(".^$*+?()[]{}|\\")


def is_plain(pattern: str) -> bool:
    """A pattern without regex syntax: a case-sensitive search for it is a
    substring test, which needs no regex engine."""
    return bool(pattern) and not (set(pattern) & _REGEX_META)


def literals(pattern: str) -> list[str] | None:
    """The alternatives of a pattern that is plain words between ``|``; None for other patterns."""
    parts = pattern.split("|")
    return parts if all(is_plain(p) for p in parts) else None


# Letters that a case-insensitive pattern takes for i, s, k or å although lower-casing a text leaves them
# or makes two letters of them; a text that has one is matched by the pattern itself.
CASELESS = ("ı", "İ", "ſ", "\u212a", "\u212b")


def folds_plainly(word: str) -> bool:
    """Whether looking for ``word.lower()`` in a lower-cased text without ``CASELESS`` letters is the
    case-insensitive search for ``word``: Latin-1 letters but for the few without a counterpart there."""
    return all(ch <= "\xff" and ch not in "\xb5\xdf\xff" for ch in word)


def matches(c, pattern, ignore_case: bool = False) -> Column:
    """True when the pattern (or any of a tuple of patterns) occurs anywhere in
    the text; null text gives false."""
    if isinstance(pattern, (tuple, list)):
        out = None
        for p in pattern:
            m = matches(c, p, ignore_case)
            out = m if out is None else (out | m)
        return out if out is not None else F.lit(False)
    words = literals(pattern)
    if not ignore_case and words:
        return F.coalesce(reduce(lambda a, b: a | b, [as_col(c).contains(w) for w in words]), F.lit(False))
    return F.coalesce(as_col(c).rlike(regex(pattern, ignore_case)), F.lit(False))


def concat_present(a, b, sep: str = ", ") -> Column:
    """``a<sep>b`` when both are present, else whichever is present (null if neither)."""
    a, b = as_col(a), as_col(b)
    return F.when(a.isNotNull() | b.isNotNull(), F.concat_ws(sep, a, b))


append_text = concat_present  # P18 under its report name
