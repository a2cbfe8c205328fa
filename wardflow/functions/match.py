"""Pattern predicates with the reference's matching rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def contains_ci(col: Column, text: str) -> Column:
    """SQL ``LIKE '%text%'`` under ASCII case-insensitive matching."""
    return col.ilike(f"%{text}%")


def regex_contains_ci(col: Column, pattern: str) -> Column:
    """``str.contains(pattern, case=False, na=False)``: regex, null -> false."""
    return F.coalesce(col.rlike("(?i)" + pattern), F.lit(False))


def code_filter(col: Column, prefixes, equals) -> Column:
    """``code LIKE 'p%' OR ... OR code = 'e' OR ...`` (prefixes case-insensitive)."""
    cond = F.lit(False)
    for p in prefixes:
        # Caseless prefixes (digits) use startswith, which reaches the Parquet scan.
        cond = cond | (col.startswith(p) if p.lower() == p.upper() else col.ilike(p + "%"))
    if equals:
        cond = cond | col.isin(list(equals))
    return cond
