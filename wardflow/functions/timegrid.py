"""Grid arithmetic on TIMESTAMP_NTZ columns.

Slots are integer indexes counted from ``grid.start``; all arithmetic is in
whole microseconds, so no time zone and no floating point is involved.
Helpers take column names or SQL expression text and return one
``F.expr`` each (a single call into the JVM; codegen is unchanged).  The
``*_sql`` forms return the text for composition.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from wardflow.config import GridSpec

EPOCH_NTZ = "1970-01-01 00:00:00"


def _c(x: str) -> str:
    """Quote a bare column name; leave expression text alone."""
    return f"`{x}`" if x.replace("_", "").isalnum() else f"({x})"


def ntz_sql(text: str) -> str:
    return f"TIMESTAMP_NTZ'{text}'"


def ntz(text: str) -> Column:
    return F.expr(ntz_sql(text))


def micros_sql(ts: str, origin: str = EPOCH_NTZ) -> str:
    """Whole microseconds from ``origin`` to ``ts`` (negative if before)."""
    return f"timestampdiff(MICROSECOND, {ntz_sql(origin)}, {_c(ts)})"


def floor_idx_sql(x: str, d: int) -> str:
    """Exact integer floor division, also for negative ``x``."""
    return f"((({x}) - pmod(({x}), {d}L)) div {d}L)"


def ceil_idx_sql(x: str, d: int) -> str:
    return f"(-{floor_idx_sql(f'-({x})', d)})"


def slot_of_sql(ts: str, grid: GridSpec, step_us: int) -> str:
    """Index of the ``step_us`` slot of the grid containing ``ts``."""
    return floor_idx_sql(micros_sql(ts, grid.start_sql), step_us)


def first_slot_at_or_after_sql(ts: str, grid: GridSpec, step_us: int) -> str:
    return ceil_idx_sql(micros_sql(ts, grid.start_sql), step_us)


def last_slot_before_sql(ts: str, grid: GridSpec, step_us: int) -> str:
    """Largest slot index whose start is strictly before ``ts``."""
    return f"({ceil_idx_sql(micros_sql(ts, grid.start_sql), step_us)} - 1L)"


def slot_start_sql(idx: str, grid: GridSpec, step_us: int) -> str:
    return f"timestampadd(MICROSECOND, {_c(idx)} * {step_us}L, {ntz_sql(grid.start_sql)})"


def filled_end_sql(end: str, grid: GridSpec) -> str:
    return f"coalesce({_c(end)}, {ntz_sql(grid.end_sql)})"


def block_range_sql(start: str, end: str, grid: GridSpec) -> tuple[str, str]:
    """(first, last) block index with ``start <= block < coalesce(end, grid.end)``.

    Clamped to the grid; the caller keeps rows with ``first <= last``.  A null
    start has no block (``greatest`` alone would skip the null).
    """
    first = (f"if({_c(start)} IS NULL, CAST(NULL AS BIGINT), "
             f"greatest({first_slot_at_or_after_sql(start, grid, grid.block_us)}, 0L))")
    last = f"least({last_slot_before_sql(filled_end_sql(end, grid), grid, grid.block_us)}, {grid.n_blocks - 1}L)"
    return first, last


def slot_of(ts: str, grid: GridSpec, step_us: int) -> Column:
    return F.expr(slot_of_sql(ts, grid, step_us))


def slot_start(idx: str, grid: GridSpec, step_us: int) -> Column:
    return F.expr(slot_start_sql(idx, grid, step_us))


def add_micros(ts: str, us: str) -> Column:
    return F.expr(f"timestampadd(MICROSECOND, {us}, {_c(ts)})")


def truncate_to_second(ts: str) -> Column:
    """SQLite ``DATETIME()`` normalisation: drop sub-second digits, keep NTZ."""
    return F.expr(f"timestampadd(MICROSECOND, -pmod({micros_sql(ts)}, 1000000L), {_c(ts)})")
