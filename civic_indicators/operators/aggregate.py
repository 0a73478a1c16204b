"""Report aggregates.

An indicator panel is computed as *one* aggregate of conditional counts
(``count(CASE WHEN cohort AND ... THEN x END)``) instead of one filtered
pass per printed number; the result is then unpivoted to a long table
(cohort, indicator, value). Every aggregate here has a map-side partial
phase, so hot groups are combined before the shuffle.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civic_indicators.functions.cols import as_col, col
from civic_indicators.functions.numbers import between, to_number
from civic_indicators.functions.patterns import AGE_GROUPS


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def count_where(cond: Column) -> Column:
    """A3: rows meeting ``cond`` (null -> not counted)."""
    return F.count(F.when(_true(cond), F.lit(1)))


def count_flag(flag, cohort: Column) -> Column:
    """A4: non-null values of a label column within the cohort."""
    return F.count(F.when(_true(cohort), as_col(flag)))


def age_predicate(age, lo=None, hi=None, hi_inclusive: bool = False, min_age=None) -> Column:
    """Guarded age range; ``min_age`` adds a lower bound to open ranges."""
    if lo is None and min_age is not None:
        lo = min_age
    return between(to_number(age), lo, hi, lo_inclusive=True, hi_inclusive=hi_inclusive)


def count_age_group(age, lo, hi, base, cohort: Column, hi_inclusive: bool = False,
                    min_age=None) -> Column:
    """A5: non-null ``base`` values in the cohort whose age is in range."""
    pred = age_predicate(age, lo, hi, hi_inclusive, min_age)
    return F.count(F.when(_true(cohort) & pred, as_col(base)))


@dataclass(frozen=True)
class PanelSpec:
    """What an indicator panel counts.

    ``flags`` maps indicator names to label columns; ``sex`` values are
    compared after the flow's own normalisation (e.g. 'M'/'F' or 'm'/'f').
    """
    sex_col: str
    male: str
    female: str
    flags: Mapping[str, str]
    age_col: str
    age_base: str | None = None          # column counted in the age groups (default sex_col)
    min_age: int | None = None           # lower bound for 'youth' (none in the reports)
    age_groups: Sequence[tuple] = field(default=AGE_GROUPS)

    def indicators(self) -> list[str]:
        return ["men", "women", *self.flags, *[g[0] for g in self.age_groups]]


def panel_columns(spec: PanelSpec, cohort: Column, prefix: str = "") -> list[Column]:
    """The conditional counts of one panel, as aggregate expressions."""
    base = spec.age_base or spec.sex_col
    sex = col(spec.sex_col)
    out = [count_where(cohort & (sex == F.lit(spec.male))).alias(prefix + "men"),
           count_where(cohort & (sex == F.lit(spec.female))).alias(prefix + "women")]
    for name, flag_col in spec.flags.items():
        out.append(count_flag(flag_col, cohort).alias(prefix + name))
    for name, lo, hi, hi_inc in spec.age_groups:
        out.append(count_age_group(spec.age_col, lo, hi, base, cohort, hi_inc, spec.min_age)
                   .alias(prefix + name))
    return out


def _long(df: DataFrame, id_cols: Sequence[str], value_cols: Sequence[str],
          var: str, val: str) -> DataFrame:
    return df.unpivot(list(id_cols), list(value_cols), var, val)


def indicator_panel(df: DataFrame, cohort: Column, spec: PanelSpec) -> DataFrame:
    """One cohort -> rows (indicator, value), from a single aggregate."""
    wide = df.agg(*panel_columns(spec, cohort))
    return _long(wide, [], spec.indicators(), "indicator", "value")


def panels(df: DataFrame, cohorts: Mapping[str, Column], spec: PanelSpec) -> DataFrame:
    """Several cohorts over the same rows in one pass -> (cohort, indicator, value)."""
    aggs, names = [], []
    for i, (name, cohort) in enumerate(cohorts.items()):
        aggs += panel_columns(spec, cohort, prefix=f"c{i}__")
        names.append(name)
    wide = df.agg(*aggs)
    structs = [F.struct(F.lit(name).alias("cohort"), F.lit(ind).alias("indicator"),
                        F.col(f"c{i}__{ind}").alias("value"))
               for i, name in enumerate(names) for ind in spec.indicators()]
    return wide.select(F.inline(F.array(*structs)))


def monthly_panels(df: DataFrame, cohorts: Mapping[str, Column], spec: PanelSpec,
                   date_cols: Mapping[str, str] | str) -> DataFrame:
    """Every cohort for every (year, month) of its own date column, long form
    (cohort, year, month, indicator, value); a cohort-month without rows has
    no row.

    Each row is tagged with the (cohort, year, month) groups it belongs to and
    exploded, so one aggregate of the panel's 11 counts serves all cohorts
    and date columns (cohorts may overlap; each counts independently). The
    shuffle carries only tagged rows, pre-aggregated map-side.
    """
    if isinstance(date_cols, str):
        date_cols = {name: date_cols for name in cohorts}
    tags = []
    for name, pred in cohorts.items():
        d = col(date_cols[name])
        tags.append(F.when(_true(pred) & d.isNotNull(),
                           F.struct(F.lit(name).alias("cohort"), F.year(d).alias("year"),
                                    F.month(d).alias("month"))))
    needed = {spec.sex_col, spec.age_col, spec.age_base or spec.sex_col, *spec.flags.values()}
    tagged = df.select(F.explode(F.array_compact(F.array(*tags))).alias("__tag"),
                       *[col(c) for c in sorted(needed)])
    wide = (tagged.groupBy(F.col("__tag.cohort").alias("cohort"), F.col("__tag.year").alias("year"),
                           F.col("__tag.month").alias("month"))
                  .agg(*panel_columns(spec, F.lit(True))))
    return _long(wide, ["cohort", "year", "month"], spec.indicators(), "indicator", "value")


def distinct_with_null(c) -> Column:
    """Number of distinct values, null counted once as a value; 0 on no rows."""
    c = as_col(c)
    return (F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))).cast("long")


def distinct_counts(df: DataFrame, columns: Mapping[str, str], by: Sequence[str] = (),
                    sums: Mapping[str, str] | None = None) -> DataFrame:
    """A7 for several columns at once: per ``by`` group (one row without it) the number of
    distinct values of each of ``columns`` (name: column), null counted once as a value, and
    the sums of ``sums`` (name: column; nulls skipped, 0 when nothing is summed).

    One scan, two levels. A row becomes one narrow (column number, value) pair per column, the
    pairs are made distinct on the map side first, so a value that holds a third of all rows
    reaches the shuffle once per task, and the second level counts pairs. Several distinct
    aggregates of one ``agg`` would copy every row once per column and once for the other
    aggregates, each copy as wide as all columns. No rows: 0 without ``by``, no row with it.
    """
    sums = dict(sums or {})
    pairs = F.array(*[F.struct(F.lit(i).alias("__i"), col(c).cast("string").alias("__v")) for i, c in enumerate(columns.values())])
    rows = df.select(*[col(b).alias(b) for b in by], *[col(c).alias(f"__s{j}") for j, c in enumerate(sums.values())], F.inline(pairs))
    parts = [F.sum(F.when(F.col("__i") == 0, F.col(f"__s{j}"))).alias(f"__s{j}") for j in range(len(sums))]
    keys = [col(b) for b in by]
    once = rows.groupBy(*keys, "__i", "__v").agg(*parts) if parts else rows.distinct()
    return once.groupBy(*keys).agg(
        *[F.count_if(F.col("__i") == i).alias(name) for i, name in enumerate(columns)],
        *[F.coalesce(F.sum(f"__s{j}"), F.lit(0)).alias(name) for j, name in enumerate(sums)])


def distinct_values(df: DataFrame, column: str, cohort: Column | None = None) -> DataFrame:
    """Distinct values (null included as a value) of one column."""
    if cohort is not None:
        df = df.filter(cohort)  # null -> dropped; stays pushable
    return df.select(col(column)).distinct()


def sum_where(c, cohort: Column) -> Column:
    """Sum over the cohort, nulls skipped, 0 when nothing is summed."""
    return F.coalesce(F.sum(F.when(_true(cohort), as_col(c))), F.lit(0))


def sum_by(df: DataFrame, key: str, c: str, cohort: Column | None = None, name: str = "total") -> DataFrame:
    """A10: per key (null keys dropped) sum of a column within the cohort."""
    if cohort is not None:
        df = df.filter(cohort)  # null -> dropped; stays pushable
    return (df.filter(col(key).isNotNull()).groupBy(col(key).alias(key))
              .agg(F.coalesce(F.sum(col(c)), F.lit(0)).alias(name)))


def sums(df: DataFrame, key: str, c: str, cohort: Column | None = None, name: str = "total", total: str = "TOTAL") -> DataFrame:
    """A9 + A10 in one pass: per key (null keys dropped) the sum of a column within the
    cohort, and the sum over all of its rows under the key ``total``."""
    if cohort is not None:
        df = df.filter(cohort)
    out = df.rollup(col(key).alias(key)).agg(F.coalesce(F.sum(col(c)), F.lit(0)).alias(name), F.grouping_id().alias("__all"))
    return (out.filter((F.col("__all") == 1) | col(key).isNotNull())
            .select(F.when(F.col("__all") == 1, F.lit(total)).otherwise(col(key)).alias(key), col(name)))


def value_counts(df: DataFrame, column: str, cohort: Column | None = None, name: str = "count",
                 sort: bool = True) -> DataFrame:
    """Frequency of each non-null value, most frequent first (ties by value)."""
    if cohort is not None:
        df = df.filter(cohort)  # null -> dropped; stays pushable
    out = df.filter(col(column).isNotNull()).groupBy(col(column).alias(column)).agg(F.count(F.lit(1)).alias(name))
    return out.orderBy(F.desc(name), F.asc(column)) if sort else out


def column_frequencies(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Value frequencies of many columns in one job: rows are unpivoted to
    (column, value) text pairs and counted by one aggregate."""
    cols = list(cols or df.columns)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in cols])
    long = df.select(F.inline(pairs))
    return (long.filter(F.col("value").isNotNull()).groupBy("column", "value")
                .agg(F.count(F.lit(1)).alias("count")))


def pivot_counts(df: DataFrame, rows: Sequence[str], column: str, labels: Sequence[str],
                 cohort: Column | None = None, other: str | None = None) -> DataFrame:
    """Counts of (rows...) x column, with a given label list (no extra job
    to discover labels); rows null in any key are dropped, empty cells are 0.

    One aggregate of conditional counts. Values outside ``labels`` are counted
    in the column named ``other``; without it, such a value is an error."""
    if cohort is not None:
        df = df.filter(cohort)  # null -> dropped; stays pushable
    keys = [*rows, column]
    df = df.filter(_not_null_all(keys))
    c = col(column)
    counts = [F.count(F.when(c == F.lit(v), F.lit(1))).alias(str(v)) for v in labels]
    unlisted = F.when(~c.isin(*labels), F.lit(1)) if labels else F.lit(1)
    if other is not None:
        counts.append(F.count(unlisted).alias(other))
    elif labels:
        seen = F.when(c == F.lit(labels[0]), F.lit(1)).when(
            ~c.isin(*labels), F.raise_error(F.concat(F.lit(f"{column}: not among the labels: "), c)).cast("int"))
        counts[0] = F.count(seen).alias(str(labels[0]))
    return df.groupBy(*[col(r).alias(r) for r in rows]).agg(*counts)


def _not_null_all(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & col(c).isNotNull()
    return cond


def daily_counts(df: DataFrame, day_col: str, cutoff=None, name: str = "count", ts: str | None = None) -> DataFrame:
    """A14 + T1: rows per day at or before ``cutoff``, in date order.

    ``ts`` names the time stamp to take the day text ``day_col`` from; the
    cutoff is then a comparison on it and reaches the scan."""
    if ts is not None:
        if cutoff is not None:
            df = df.filter(col(ts) < F.lit(str(_dt.date.fromisoformat(str(cutoff)) + _dt.timedelta(days=1))).cast(dict(df.dtypes)[ts]))
        df = df.select(F.date_format(col(ts), "yyyy-MM-dd").alias(day_col))
    elif cutoff is not None:
        df = df.filter(col(day_col) <= F.lit(cutoff))
    return (df.filter(col(day_col).isNotNull()).groupBy(col(day_col).alias(day_col))
              .agg(F.count(F.lit(1)).alias(name)).orderBy(day_col))


def profile(df: DataFrame) -> DataFrame:
    """One row per column: (column, type, non_null, rows), from one aggregate."""
    aggs = [F.count(F.lit(1)).alias("__rows")] + [F.count(col(c)).alias(f"__nn{i}") for i, c in enumerate(df.columns)]
    wide = df.agg(*aggs)
    structs = [F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"),
                        F.col(f"__nn{i}").alias("non_null"))
               for i, (c, t) in enumerate(df.dtypes)]
    return wide.select(F.inline(F.array(*structs)), F.col("__rows").alias("rows"))


def preview(df: DataFrame, order: Sequence[str] | str, n: int = 5) -> DataFrame:
    """First ``n`` rows in a stated order (top-k per partition, then merged)."""
    order = [order] if isinstance(order, str) else list(order)
    return df.orderBy(*[col(c) for c in order]).limit(n)


def union_ids(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct union of two id sets."""
    return a.union(b).distinct()
