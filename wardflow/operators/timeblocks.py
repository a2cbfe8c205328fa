"""Intervals -> grid blocks and sub-blocks; interval coverage counts.

A row belongs to block ``b`` iff ``start <= b < coalesce(end, grid.end)``
and then to all sub-blocks of ``b``.  The block range of each interval is
closed-form (no theta join against the grid); the expansion is one bounded
``sequence`` + ``explode`` whose work is proportional to its output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from wardflow import config as C
from wardflow.config import GridSpec
from wardflow.functions.timegrid import block_range_sql, filled_end_sql, last_slot_before_sql, slot_start_sql

_FIRST, _LAST = "_first_block", "_last_block"


def add_block_range(df: DataFrame, start: str, end: str, grid: GridSpec) -> DataFrame:
    """Add the first/last block index of each interval in ``grid``, replacing earlier ones (no rows dropped)."""
    first, last = block_range_sql(start, end, grid)
    return df.withColumns({_FIRST: F.expr(first), _LAST: F.expr(last)})


def with_block_range(df: DataFrame, start: str, end: str, grid: GridSpec) -> DataFrame:
    """Block indexes, keeping only intervals that cross a grid point."""
    return add_block_range(df, start, end, grid).where(F.col(_FIRST) <= F.col(_LAST))


def _sub_rows(df: DataFrame, grid: GridSpec, keep: list[str]) -> DataFrame:
    spb = grid.subs_per_block
    df = df.select(*keep, F.expr(f"explode(sequence({_FIRST} * {spb}L, {_LAST} * {spb}L + {spb - 1}L))")
                   .alias("_sub"))
    return df.withColumns({C.B12: F.expr(slot_start_sql(f"_sub div {spb}L", grid, grid.block_us)),
                           C.B4: F.expr(slot_start_sql("_sub", grid, grid.sub_us))})


def expand_stays(cohort: DataFrame, grid: GridSpec) -> DataFrame:
    """Expanded patients: SUBJECT_ID, HADM_ID, CURR_CAREUNIT, TIME_BLOCK_12HR,
    TIME_BLOCK_4HR, ADMISSION_DATE, DISCHARGE_DATE (open end filled)."""
    df = _sub_rows(with_block_range(cohort, C.ADMIT, C.DISCHARGE, grid), grid,
                   [C.SUBJECT_ID, C.HADM_ID, C.UNIT, C.ADMIT, C.DISCHARGE])
    return df.select(C.SUBJECT_ID, C.HADM_ID, C.UNIT, C.B12, C.B4, C.ADMIT,
                     F.expr(filled_end_sql(C.DISCHARGE, grid)).alias(C.DISCHARGE))


def expand_staff(staff: DataFrame, grid: GridSpec) -> DataFrame:
    """Expanded staff: CGID, CURR_CAREUNIT, TIME_BLOCK_12HR, TIME_BLOCK_4HR."""
    df = _sub_rows(with_block_range(staff, C.START, C.END, grid), grid, [C.CGID, C.UNIT])
    return df.select(C.CGID, C.UNIT, C.B12, C.B4)


def coverage_counts(intervals: DataFrame, key: str, first: str, last: str) -> DataFrame:
    """Number of intervals covering each slot, per ``key``: (key, slot, n), n > 0.

    Each interval becomes two delta events (+1 at ``first``, -1 after
    ``last``), pre-aggregated map-side per (key, slot); a running sum over the
    slots of each key (at most grid-size rows) gives the counts, and each
    constant segment is expanded once.  Work is linear in the intervals, not
    in the interval lengths, and no key is ever held whole by one task.
    """
    ev = intervals.select(key, F.expr(
        f"explode(array(named_struct('slot', {first}, 'd', 1L), named_struct('slot', ({last}) + 1L, 'd', -1L)))"
    ).alias("e"))
    deltas = ev.groupBy(key, F.col("e.slot").alias("slot")).agg(F.sum("e.d").alias("d"))
    w = Window.partitionBy(key).orderBy("slot")
    seg = deltas.select(key, "slot",
                        F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("n"),
                        F.lead("slot").over(w).alias("next"))
    return seg.where("n > 0 AND next IS NOT NULL").select(
        key, F.expr("explode(sequence(slot, next - 1L))").alias("slot"), "n")


def _known_unit(df: DataFrame, start: str, end: str, grid: GridSpec) -> DataFrame:
    return with_block_range(df, start, end, grid).where(F.col(C.UNIT).isNotNull())


def stay_sub_coverage(cohort: DataFrame, grid: GridSpec) -> DataFrame:
    """Patients present per (unit, sub-block): rows with admit <= b4 < discharge.

    Closed form of the expanded rows' presence: sub-blocks from the first
    block's start to the last sub-block starting before the (filled)
    discharge.  Null units are dropped (pandas groupby rule).
    """
    spb = grid.subs_per_block
    last_sub = (f"least({_LAST} * {spb}L + {spb - 1}L, "
                f"{last_slot_before_sql(filled_end_sql(C.DISCHARGE, grid), grid, grid.sub_us)})")
    return coverage_counts(_known_unit(cohort, C.ADMIT, C.DISCHARGE, grid), C.UNIT, f"{_FIRST} * {spb}L", last_sub)


def shift_block_coverage(staff: DataFrame, grid: GridSpec) -> DataFrame:
    """Shifts present per (unit, block) — each counts once per block."""
    return coverage_counts(_known_unit(staff, C.START, C.END, grid), C.UNIT, _FIRST, _LAST)


def stay_block_coverage(cohort: DataFrame, grid: GridSpec) -> DataFrame:
    return coverage_counts(_known_unit(cohort, C.ADMIT, C.DISCHARGE, grid), C.UNIT, _FIRST, _LAST)


def discharge_slots(cohort: DataFrame, grid: GridSpec) -> DataFrame:
    """Discharges per (unit, sub-block index), counted as the reference does.

    Within a stay's block, the slot is the first sub-block start at or after
    the (filled) discharge.  As every expanded block starts before the
    discharge, only the stay's last block can hold it: sub-block 1 if
    discharge <= b + 1 sub, 2 if <= b + 2 subs, ...; sub-block 0 never.
    """
    spb = grid.subs_per_block
    first_sub_at = f"({last_slot_before_sql(filled_end_sql(C.DISCHARGE, grid), grid, grid.sub_us)} + 1L)"
    df = _known_unit(cohort, C.ADMIT, C.DISCHARGE, grid).select(C.UNIT, F.expr(first_sub_at).alias("slot"), _LAST)
    df = df.where(f"slot <= {_LAST} * {spb}L + {spb - 1}L")
    return df.groupBy(C.UNIT, "slot").agg(F.count(F.lit(1)).alias("n"))
