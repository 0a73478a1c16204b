"""Population classification from free text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from civic_indicators.functions.cols import as_col, quote, sql_string
from civic_indicators.functions.text import CASELESS, folds_plainly, literals, matches, regex


def _sql_ok(c, rules) -> bool:
    """Use the one-expression path for a column name and backslash-free patterns
    (a backslash's meaning in a SQL literal depends on a session setting)."""
    return isinstance(c, str) and not any("\\" in p or "\\" in label for p, label in rules)


def _contains_sql(text: str, words: Sequence[str]) -> str:
    return " OR ".join(f"contains({text}, {sql_string(w)})" for w in words)


def _match_sql(name: str, pattern: str, ignore_case: bool, lowered: bool = False) -> str:
    """Whether the pattern occurs; plain words are looked for as such, in the text lowered once if ``lowered``."""
    words = literals(pattern)
    if words and not ignore_case:
        return f"coalesce({_contains_sql(quote(name), words)}, false)"
    if words and lowered and all(folds_plainly(w) for w in words):
        return f"coalesce({_contains_sql(f'lower({quote(name)})', [w.lower() for w in words])}, false)"
    return f"coalesce({quote(name)} RLIKE {sql_string(regex(pattern, ignore_case))}, false)"


def label_last_match(c, rules: Sequence[tuple[str, str]], ignore_case: bool = True) -> Column:
    """The label of the *last* rule whose pattern occurs; null if none or null text.

    Built as one CASE over the reversed rule list, so the whole rule set is a
    single projected expression: the text is lowered once and rules of plain words are
    substring tests of it; rules with pattern syntax stay case-insensitive patterns, as do all
    rules for a text with a letter that lower-casing does not fold.
    """
    if not rules:
        return F.lit(None).cast("string")
    if _sql_ok(c, rules):  # one SQL expression: the same CASE, built in one JVM call
        def case(lowered: bool) -> str:
            return "CASE " + " ".join(f"WHEN {_match_sql(c, p, ignore_case, lowered)} THEN {sql_string(label)}" for p, label in reversed(list(rules))) + " END"

        by_pattern, by_words = case(False), case(True)
        if by_pattern == by_words:
            return F.expr(by_pattern)
        return F.expr(f"CASE WHEN {_contains_sql(quote(c), CASELESS)} THEN {by_pattern} ELSE {by_words} END")
    c = as_col(c)
    out = None
    for pattern, label in reversed(list(rules)):
        cond = matches(c, pattern, ignore_case)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out if out is not None else F.lit(None).cast("string")


def any_of(*predicates: Column) -> Column:
    """Null-safe OR: a null predicate counts as false."""
    return reduce(lambda a, b: a | b, [F.coalesce(p, F.lit(False)) for p in predicates])


def flag(label: str, *predicates: Column) -> Column:
    """``label`` when any predicate holds, else null."""
    return F.when(any_of(*predicates), F.lit(label))


def labels_all(c, rules: Sequence[tuple[str, str]], ignore_case: bool = False) -> Column:
    """Every matching label in rule order, as an array; null when none match."""
    if _sql_ok(c, rules):
        items = ", ".join(f"CASE WHEN {_match_sql(c, p, ignore_case)} THEN {sql_string(label)} END"
                          for p, label in rules)
        return F.expr(f"CASE WHEN size(array_compact(array({items}))) > 0 "
                      f"THEN array_compact(array({items})) END")
    c = as_col(c)
    arr = F.array_compact(F.array(*[F.when(matches(c, p, ignore_case), F.lit(label))
                                    for p, label in rules]))
    return F.when(F.size(arr) > 0, arr)


def any_flag(*cols) -> Column:
    """C4: true when at least one of the label columns is present."""
    return F.coalesce(*[as_col(c) for c in cols]).isNotNull()
