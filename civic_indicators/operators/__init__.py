"""DataFrame-level operators."""

from civic_indicators.operators import aggregate, clean, cohorts, integrate  # noqa: F401
from civic_indicators.operators.aggregate import (
    PanelSpec, column_frequencies, count_age_group, count_flag, count_where, daily_counts,
    distinct_counts, distinct_values, distinct_with_null, indicator_panel, monthly_panels, panels, pivot_counts,
    preview, profile, sum_by, sum_where, sums, union_ids, value_counts,
)
from civic_indicators.operators.clean import (
    assign_where, clean_text, drop_empty, empty_to_null, fill, lower_strings, missing_any,
    null_sentinels, null_values, project, recode, replace_columns, sort_by, split_valid, where_equals,
)
from civic_indicators.operators.integrate import (
    coalesce_join, distinct_concat, drop_ids, enrich, first_per_key, first_values, keep_ids, mark_ids,
    outer_by_person, outer_merge, per_key, person_key,
)

__all__ = [
    "PanelSpec", "column_frequencies", "count_age_group", "count_flag", "count_where",
    "daily_counts", "distinct_counts", "distinct_values", "distinct_with_null", "indicator_panel", "monthly_panels",
    "panels", "pivot_counts", "preview", "profile", "sum_by", "sum_where", "sums", "union_ids",
    "value_counts", "assign_where", "clean_text", "drop_empty", "empty_to_null", "fill",
    "lower_strings", "missing_any", "null_sentinels", "null_values", "project", "recode",
    "replace_columns", "sort_by", "split_valid", "where_equals", "distinct_concat", "drop_ids", "enrich",
    "first_values", "keep_ids", "mark_ids", "outer_merge", "per_key", "person_key",
    "coalesce_join", "first_per_key", "outer_by_person",
]
