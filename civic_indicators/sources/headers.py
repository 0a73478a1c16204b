"""Header operations (S2-S5): pure renames, no data is touched."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame


def unique_names(names: Iterable[str]) -> list[str]:
    """Give repeated headers a ``.1``, ``.2`` suffix, as a sheet reader does."""
    seen: dict[str, int] = {}
    taken = set()
    out = []
    for n in names:
        if n not in seen:
            seen[n] = 0
            out.append(n)
            taken.add(n)
            continue
        k = seen[n]
        while True:
            k += 1
            cand = f"{n}.{k}"
            if cand not in taken:
                break
        seen[n] = k
        taken.add(cand)
        out.append(cand)
    return out


def with_unique_headers(df: DataFrame) -> DataFrame:
    names = unique_names(df.columns)
    return df if names == df.columns else df.toDF(*names)


def normalized(name: str, spaces: bool = True) -> str:
    name = name.lower()
    return name.replace(" ", "_") if spaces else name


def normalize_headers(df: DataFrame, spaces: bool = True) -> DataFrame:
    """Lower-case headers and turn spaces into '_'; two headers that
    normalise to the same name are an error rather than a silent merge."""
    new = [normalized(c, spaces) for c in df.columns]
    dup = sorted({n for n in new if new.count(n) > 1})
    if dup:
        raise ValueError(f"headers collide after normalisation: {dup}")
    return df.toDF(*new)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """S3: rename by exact name; absent names are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def rename_by_pattern(df: DataFrame, pattern: str, to: str, regex: bool = False) -> DataFrame:
    """Replace a substring (or regex) inside every header."""
    if regex:
        new = [re.sub(pattern, to, c) for c in df.columns]
    else:
        new = [c.replace(pattern, to) for c in df.columns]
    return df.toDF(*new)


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop by exact name (names with dots or spaces included)."""
    cols = [c for c in cols if c in df.columns]
    return df.drop(*cols) if cols else df       # by exact name: dots and spaces are not parsed
