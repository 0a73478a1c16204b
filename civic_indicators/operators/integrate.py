"""Per-person integration: first values per key (A1), ordered distinct
concatenation (A2), outer merge (J1/J2), enrichment (J3/J4) and id sets (J5).

Scale notes
-----------
* ``first_values`` is one aggregate of ``min_by`` expressions with a partial
  (map-side) phase, so a key holding a third of all rows reaches the final
  aggregate as one partial row per map task. With text values the buffers
  are variable-width and Spark aggregates by sorting, which spills to disk
  gracefully instead of failing.
* ``distinct_concat`` first deduplicates (key, value) pairs with a partial
  ``min`` of the order, spreading a hot key over its distinct values; only
  the distinct values of a key (what the output string holds anyway) meet in
  one group.
* ``per_key`` does both in one scan and one two-level aggregation.
* ``outer_merge`` is a full outer join that reuses the partitioning its
  per-person side was aggregated by. For a key known to be hot,
  ``hot_keys=True`` runs it as one left join (stub rows for the right-only
  keys are added to the left side), which adaptive execution can split and a
  full outer join it cannot; it scans the two key columns once more.
* ``enrich`` compares keys null-safely so the per-key side is shuffled by the
  join key, which is what lets adaptive execution split a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civic_indicators.functions.cols import col, quote, sql_string
from civic_indicators.functions.patterns import SENTINELS
from civic_indicators.functions.text import strip

_ORD = "__ord"
_COL = "__col"
_VAL = "__val"
_SEEN = "__seen"
_HELD = "__held"


def order_key(order: Sequence[str] | str) -> Column:
    """A sortable row order from one or several columns (ties broken left to right)."""
    order = [order] if isinstance(order, str) else list(order)
    return col(order[0]) if len(order) == 1 else F.struct(*[col(c).alias(f"o{i}") for i, c in enumerate(order)])


def person_key(c, missing: Sequence[str] = ("", *SENTINELS)) -> Column:
    """Q18: join keys as trimmed text, so '123', 123 and ' 123 ' meet; blank and
    sentinel numbers are nobody's (null)."""
    k = strip(c if isinstance(c, Column) else col(c)).cast("string")
    return F.when(~k.isin(*missing), k)


def _order_sql(order: Sequence[str] | str) -> str:
    order = [order] if isinstance(order, str) else list(order)
    if len(order) == 1:
        return quote(order[0])
    return "named_struct(" + ", ".join(f"'o{i}', {quote(c)}" for i, c in enumerate(order)) + ")"


# The operators below write each projected column and each aggregate as one
# SQL expression: the same plan as the Column API, built with one JVM call per
# expression instead of one per node.

def first_values(df: DataFrame, key: str, cols: Sequence[str], order: Sequence[str] | str) -> DataFrame:
    """A1: first non-null value of each column per key, in ``order``; null keys dropped.

    The order key is projected once; each column keeps the value whose
    (non-null) row has the smallest order key.
    """
    k = quote(key)
    rows = (df.filter(col(key).isNotNull())
              .selectExpr(f"{k} AS {k}", f"{_order_sql(order)} AS {_ORD}", *[quote(c) for c in cols]))
    aggs = [F.expr(f"min_by({quote(c)}, CASE WHEN {quote(c)} IS NOT NULL THEN {_ORD} END) AS {quote(c)}")
            for c in cols]
    return rows.groupBy(col(key)).agg(*aggs)


first_per_key = first_values  # A1 under its report name


def _pairs_sql(names: Sequence[str], value_cols: Sequence[str]) -> str:
    items = ", ".join(f"named_struct('{_COL}', {sql_string(n)}, '{_VAL}', {v})" for n, v in zip(names, value_cols))
    return f"inline(array({items}))"


def _joined_sql(name: str, sep: str) -> str:
    return (f"array_join(array_distinct(transform(filter(__items, x -> x.{_COL} = {sql_string(name)} AND x.{_VAL} IS NOT NULL), "
            f"x -> x.{_VAL})), {sql_string(sep)}) AS {quote(name)}")


_ITEMS_SQL = (f"array_sort(collect_list(CASE WHEN {_VAL} IS NOT NULL "
              f"THEN named_struct('{_SEEN}', {_SEEN}, '{_COL}', {_COL}, '{_VAL}', {_VAL}) END)) AS __items")


def distinct_concat(df: DataFrame, key: str, cols: Sequence[str], order: Sequence[str] | str,
                    sep: str = ",") -> DataFrame:
    """A2: per non-null key, the distinct non-null values of each column joined
    by ``sep`` in first-seen order; '' when a key has no value in a column."""
    k = quote(key)
    cols = list(cols)
    base = (df.filter(col(key).isNotNull())
              .selectExpr(f"{k} AS {k}", f"{_order_sql(order)} AS {_ORD}",
                          *[f"CAST({quote(c)} AS STRING) AS __c{i}" for i, c in enumerate(cols)]))
    long = base.selectExpr(k, _ORD, _pairs_sql(cols, [f"__c{i}" for i in range(len(cols))]))
    # Stage 1 (partial + final aggregate on key, column, value): one row per
    # distinct value; a null value keeps the key present at no extra cost.
    seen = long.groupBy(col(key), _COL, _VAL).agg(F.expr(f"min({_ORD}) AS {_SEEN}"))
    out = seen.groupBy(col(key)).agg(F.expr(_ITEMS_SQL))
    return out.selectExpr(k, *[_joined_sql(c, sep) for c in cols])


def per_key(df: DataFrame, key: str, order: Sequence[str] | str, first: Sequence[str] = (),
            concat: Sequence[str] = (), sep: str = ",") -> DataFrame:
    """A1 + A2 for one table: one row per non-null key, ``first`` columns by
    first non-null value, ``concat`` columns by ordered distinct join ('' when
    a key has no value).

    One scan and one two-level aggregation, no self-join. Level 1 groups by
    (key, concat values, which first columns are null) and keeps the group's
    row with the smallest order: within a group a column is null in every row
    or in none, so that row holds the group's first value of each column, and
    a row's order travels once, not once per column. Level 2 groups by key:
    it orders the distinct concat values by the order of their first group and
    picks each first column's value from the first group that has one. A hot
    key is spread over its distinct values at level 1, and reaches level 2 as
    one row per distinct group.
    """
    first, concat = list(first), list(concat)
    if not concat:
        return first_values(df, key, first, order)
    if not first:
        return distinct_concat(df, key, concat, order, sep)
    types = dict(df.dtypes)
    if any("map<" in types[c] or "variant" in types[c] for c in first):  # values without an order
        return first_values(df, key, first, order).join(distinct_concat(df, key, concat, order, sep), key)
    k = quote(key)
    fcols = [f"__f{i}" for i in range(len(first))]
    base = (df.filter(col(key).isNotNull())
              .selectExpr(f"{k} AS {k}", f"{_order_sql(order)} AS {_ORD}",
                          *[f"{quote(c)} AS {f}" for c, f in zip(first, fcols)],
                          *[f"CAST({quote(c)} AS STRING) AS __c{i}" for i, c in enumerate(concat)]))
    # The first columns go with the first concat column only; a row without an order has no say in them.
    known = f"{_ORD} IS NOT NULL"
    own = [f"CASE WHEN {known} AND {_COL} = {sql_string(concat[0])} THEN {f} END AS {f}" for f in fcols]
    long = (base.selectExpr(k, _ORD, *fcols, _pairs_sql(concat, [f"__c{i}" for i in range(len(concat))]))
                .selectExpr(k, _ORD, _COL, _VAL, *own))
    held = "concat(" + ", ".join(f"CASE WHEN {f} IS NULL THEN '0' ELSE '1' END" for f in fcols) + ")"
    # A first column that is part of the order is not held twice.
    names = [order] if isinstance(order, str) else list(order)
    place = {f: _SEEN if len(names) == 1 else f"{_SEEN}.o{names.index(c)}" for f, c in zip(fcols, first) if c in names}
    rest = [f for f in fcols if f not in place]
    row = f"named_struct('{_SEEN}', {_ORD}" + "".join(f", '{f}', {f}" for f in rest) + ")"
    level1 = (long.selectExpr("*", f"{held} AS {_HELD}").groupBy(col(key), _COL, _VAL, _HELD)
                  .agg(F.expr(f"min(CASE WHEN {known} THEN {row} END) AS __row")))
    item = (f"named_struct('{_SEEN}', __row.{_SEEN}, '{_COL}', {_COL}, '{_VAL}', {_VAL}, '{_HELD}', {_HELD}"
            + "".join(f", '{f}', __row.{f}" for f in rest) + ")")
    level2 = level1.groupBy(col(key)).agg(F.expr(f"array_sort(collect_list({item})) AS __items"))
    if len(order) == 1 or isinstance(order, str):  # a value has no order only if none of its rows has one
        level2 = level2.selectExpr(k, f"filter(__items, x -> x.{_SEEN} IS NOT NULL OR NOT exists(__items, y -> y.{_SEEN} IS NOT NULL "
                                      f"AND y.{_COL} = x.{_COL} AND y.{_VAL} <=> x.{_VAL})) AS __items")
    picked = [f"try_element_at(filter(__items, x -> substr(x.{_HELD}, {i + 1}, 1) = '1'), 1).{place.get(f, f)} AS {quote(c)}"
              for i, (c, f) in enumerate(zip(first, fcols))]
    return level2.selectExpr(k, *picked,
                             *[_joined_sql(c, sep) for c in concat])


def outer_merge(left: DataFrame, right: DataFrame, on: str,
                overlap: Sequence[str] | None = None, hot_keys: bool = False) -> DataFrame:
    """J1 + J2: full outer join on ``on``; for overlapping columns the left
    value wins unless it is null. Columns that exist on one side only pass;
    null keys match nothing.

    ``hot_keys=True`` gives the same rows by one left join that adaptive
    execution can split at a hot key of ``left``: the left side gets a key-only
    stub row for every right key it lacks (from a second scan of both key
    columns), so the stubs pick up the right-only rows. Right rows with a null
    key carry tag 1 and are picked up by a single (null, 1) stub through a
    null-safe comparison, while real left rows carry tag 0.
    """
    if overlap is None:
        overlap = [c for c in left.columns if c in set(right.columns) and c != on]
    overlap = list(overlap)
    r_only = [c for c in right.columns if c != on and c not in set(left.columns)]
    rname = {c: f"{c}__r" for c in overlap}
    k = quote(on)
    if not hot_keys:
        r = right.selectExpr(f"{k} AS __rk", *[f"{quote(c)} AS {quote(rname[c])}" for c in overlap], *[quote(c) for c in r_only])
        both = left.join(r, col(on) == F.col("__rk"), "full_outer")
        out = [f"coalesce({k}, __rk) AS {k}" if c == on else f"coalesce({quote(c)}, {quote(rname[c])}) AS {quote(c)}"
               if c in rname else quote(c) for c in left.columns]
        return both.selectExpr(*out, *[quote(c) for c in r_only])
    r = right.selectExpr(f"{k} AS __rk", f"CAST({k} IS NULL AS INT) AS __rt",
                         *[f"{quote(c)} AS {quote(rname[c])}" for c in overlap], *[quote(c) for c in r_only])
    left_keys = left.select(col(on)).filter(col(on).isNotNull()).distinct()
    stubs = r.selectExpr(f"__rk AS {k}", "__rt AS __lt").distinct().join(left_keys, on, "left_anti")
    widened = left.withColumn("__lt", F.lit(0)).unionByName(stubs, allowMissingColumns=True)
    cond = [col(on).eqNullSafe(F.col("__rk")), F.col("__lt") == F.col("__rt")]
    both = widened.join(r, cond, "left")
    out = [f"coalesce({quote(c)}, {quote(rname[c])}) AS {quote(c)}" if c in rname else quote(c)
           for c in left.columns]
    return both.selectExpr(*out, *[quote(c) for c in r_only])


outer_by_person = outer_merge  # J1 under its report name


def coalesce_join(left: DataFrame, right: DataFrame, on: str, how: str = "full_outer",
                  cols: Sequence[str] | None = None) -> DataFrame:
    """Join on ``on`` and merge overlapping columns (left value unless null).

    ``how='full_outer'`` is ``outer_merge``; other join types keep the
    columns of both sides and coalesce the overlapping ones after the join.
    """
    if how in ("full_outer", "outer", "full"):
        return outer_merge(left, right, on, cols)
    overlap = list(cols) if cols is not None else [c for c in left.columns if c in set(right.columns) and c != on]
    r_only = [c for c in right.columns if c != on and c not in set(left.columns)]
    r = right.selectExpr(quote(on), *[f"{quote(c)} AS {quote(c + '__r')}" for c in overlap], *[quote(c) for c in r_only])
    joined = left.join(r, on, how)
    keep = [f"coalesce({quote(c)}, {quote(c + '__r')}) AS {quote(c)}" if c in overlap else quote(c)
            for c in [on] + [c for c in left.columns if c != on]]
    return joined.selectExpr(*keep, *[quote(c) for c in r_only])


def enrich(df: DataFrame, other: DataFrame, on: str, cols: Sequence[str]) -> DataFrame:
    """Left join a few columns of a table with one row per key.

    No hint: adaptive execution turns it into a broadcast join when the
    per-key side is *measured* below the broadcast threshold at run time, and
    keeps the sort-merge join otherwise. Right-side null keys are dropped
    (they never match) and the keys are compared null-safely, which yields
    the plain equi-join result but makes the planner shuffle the per-key side
    by the join key instead of reusing its aggregate's partitioning: only
    then can adaptive execution split the partition of a hot key on ``df``.
    """
    r = other.filter(col(on).isNotNull()).select(col(on).alias("__ek"), *[col(c) for c in cols])
    return df.join(r, col(on).eqNullSafe(F.col("__ek")), "left").drop("__ek")


def keep_ids(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Rows whose id is in ``ids`` (semi join)."""
    return df.join(ids.select(col(on)), on, "left_semi")


def drop_ids(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Rows whose id is not in ``ids`` (anti join)."""
    return df.join(ids.select(col(on)), on, "left_anti")


def mark_ids(df: DataFrame, ids: DataFrame, on: str, name: str = "in_ids") -> DataFrame:
    """J5 in one pass: every row of ``df`` with a flag telling whether its id is
    in ``ids`` (the semi and the anti join of ``keep_ids``/``drop_ids`` as one
    left join against the distinct ids)."""
    hits = (ids.filter(col(on).isNotNull()).select(col(on).alias("__id")).distinct()
               .withColumn("__hit", F.lit(True)))
    # null-safe comparison (ids has no nulls): the distinct ids are shuffled by
    # the join key, so a hot id on ``df`` can be split, as in ``enrich``
    return (df.join(hits, col(on).eqNullSafe(F.col("__id")), "left")
              .withColumn(name, F.coalesce(F.col("__hit"), F.lit(False))).drop("__hit", "__id"))
