"""Notebook summaries as aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardflow import config as C
from wardflow.config import GridSpec
from wardflow.functions.timegrid import slot_start
from wardflow.operators import timeblocks as tb
from wardflow.operators.timeblocks import _LAST, with_block_range


def staff_block_counts(staff: DataFrame, grid: GridSpec) -> DataFrame:
    """Non-null CGID count of the expanded staff rows per unit and block
    (each shift contributes one row per sub-block)."""
    cov = tb.shift_block_coverage(staff.where(F.col(C.CGID).isNotNull()), grid)
    return cov.select(C.UNIT, slot_start("slot", grid, grid.block_us).alias(C.B12),
                      (F.col("n") * grid.subs_per_block).cast("bigint").alias("NURSE_COUNT"))


def subject_block_counts(cohort: DataFrame, grid: GridSpec) -> DataFrame:
    """Non-null SUBJECT_ID count of the expanded patient rows per unit and block."""
    cov = tb.stay_block_coverage(cohort.where(F.col(C.SUBJECT_ID).isNotNull()), grid)
    return cov.select(C.UNIT, slot_start("slot", grid, grid.block_us).alias(C.B12),
                      (F.col("n") * grid.subs_per_block).cast("bigint").alias("SUBJECT_COUNT"))


def last_unit_with_labs(cohort: DataFrame, grid: GridSpec, latest: dict[str, DataFrame]) -> DataFrame:
    """Unit at each admission's last block (of several rows the latest admit, then the largest unit), with each subject's latest tests
    (``latest`` maps a name to a per-subject table keyed by SUBJECT_ID)."""
    r = with_block_range(cohort, C.ADMIT, C.DISCHARGE, grid)
    last = r.groupBy(C.SUBJECT_ID, C.HADM_ID).agg(
        F.max_by(C.UNIT, F.struct(_LAST, C.ADMIT, C.UNIT)).alias(C.UNIT), F.max(_LAST).alias("_k"))
    out = last.select(C.SUBJECT_ID, C.HADM_ID, C.UNIT,
                      slot_start("_k", grid, grid.block_us).alias(C.B12))
    for df in latest.values():
        out = out.join(df, C.SUBJECT_ID, "left")
    return out


def tested_counts_by_unit(last_unit: DataFrame, value_cols: dict[str, str]) -> DataFrame:
    """Per unit, admissions and non-null test values (null unit dropped)."""
    aggs = [F.count(C.SUBJECT_ID).alias("PATIENT_COUNT")]
    aggs += [F.count(c).alias(name) for c, name in value_cols.items()]
    return last_unit.where(F.col(C.UNIT).isNotNull()).groupBy(C.UNIT).agg(*aggs)
