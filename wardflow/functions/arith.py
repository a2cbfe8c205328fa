"""Safe arithmetic with the reference's float semantics mapped to SQL NULLs."""

from __future__ import annotations


def ratio_or_zero_sql(num: str, den: str) -> str:
    """``num / den`` with division by zero giving 0 (reference: inf -> 0)."""
    return f"coalesce(try_divide(CAST({num} AS DOUBLE), CAST({den} AS DOUBLE)), 0D)"


def ratio_or_null_sql(num: str, den: str) -> str:
    """``num / den``; NULL stands for the NaN of 0/0."""
    return f"try_divide(CAST({num} AS DOUBLE), CAST({den} AS DOUBLE))"


def mean_skip_null_sql(*cols: str) -> str:
    """Row-wise mean of the non-null values; NULL if all are null."""
    total = " + ".join(f"coalesce({c}, 0D)" for c in cols)
    count = " + ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in cols)
    return f"try_divide({total}, CAST({count} AS DOUBLE))"
