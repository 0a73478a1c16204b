"""Sources and sinks: scans, header normalisation, curated/quarantine writers."""

from civic_indicators.sources.headers import (
    drop_columns, normalize_headers, rename, rename_by_pattern, unique_names, with_unique_headers,
)
from civic_indicators.sources.readers import scan, split_malformed, table
from civic_indicators.sources.sinks import is_published, publish, published, write_curated, write_quarantine, write_split

__all__ = [
    "drop_columns", "normalize_headers", "rename", "rename_by_pattern", "unique_names",
    "with_unique_headers", "scan", "split_malformed", "table", "is_published", "publish", "published",
    "write_curated", "write_quarantine", "write_split",
]
