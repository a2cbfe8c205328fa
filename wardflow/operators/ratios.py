"""Per unit and 12 h block, a sub-block ratio, its unit-normalised
value and the 12 h summary with positional slots.

All inputs are first reduced to counts per (unit, sub-block) — at most
units x grid slots rows — so the full outer join, the unit mean and the
positional pivot run on a table whose size is independent of the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardflow import config as C
from wardflow.config import GridSpec
from wardflow.functions.arith import mean_skip_null_sql, ratio_or_null_sql, ratio_or_zero_sql
from wardflow.functions.timegrid import slot_start_sql
from wardflow.operators import timeblocks as tb


def _staff_per_sub(staff: DataFrame, grid: GridSpec) -> DataFrame:
    """Shifts per (unit, sub-block): a shift counts in every sub-block of its blocks.

    Counted once per block, then the small count table is replicated to
    the sub-blocks (a third of the rows of counting expanded sub-blocks).
    """
    spb = grid.subs_per_block
    blocks = tb.shift_block_coverage(staff, grid)
    return blocks.select(C.UNIT, F.expr(f"explode(sequence(slot * {spb}L, slot * {spb}L + {spb - 1}L))")
                         .alias("slot"), "n")


def unit_block_ratio(num: DataFrame, staff: DataFrame, grid: GridSpec, *, num_name: str,
                     ratio_sql: str, num_zero_as=None, num_prefix: str,
                     staff_prefix: str = "NURSES_4HR", ratio_prefix: str, avg_name: str,
                     slot_mode: str = "positional") -> DataFrame:
    """Shared plan of O5 and O6 over (unit, slot, n) count tables.

    ``ratio_sql`` is an expression over ``{num_name}`` and ``num_nurses``.
    ``slot_mode='positional'`` (reference parity) numbers the present
    sub-blocks of a block in time order; ``'clock'`` uses the sub-block's
    position in the block (00/04/08 h -> 1/2/3), missing ones reading 0.
    """
    if slot_mode not in ("positional", "clock"):
        raise ValueError(f"slot_mode must be 'positional' or 'clock', not {slot_mode!r}")
    spb = grid.subs_per_block
    n = F.coalesce(F.col(num_name), F.lit(0))
    if num_zero_as is not None:
        n = F.when(n == 0, F.lit(num_zero_as)).otherwise(n)
    merged = (num.select(C.UNIT, "slot", F.col("n").alias(num_name))
              .join(staff.select(C.UNIT, "slot", F.col("n").alias("num_nurses")), [C.UNIT, "slot"], "full")
              .select(C.UNIT, "slot", n.alias(num_name),
                      F.coalesce(F.col("num_nurses"), F.lit(0)).alias("num_nurses")))
    merged = merged.withColumn("ratio", F.expr(ratio_sql))
    unit_mean = merged.groupBy(C.UNIT).agg(F.avg("ratio").alias("_unit_mean"))
    merged = merged.join(unit_mean, C.UNIT).selectExpr(
        C.UNIT, "slot", num_name, "num_nurses", "ratio",
        f"{ratio_or_null_sql('ratio', '_unit_mean')} AS norm", f"slot div {spb}L AS block",
        ("row_number() OVER (PARTITION BY CURR_CAREUNIT, slot div %dL ORDER BY slot) AS pos" % spb
         if slot_mode == "positional" else f"CAST(pmod(slot, {spb}L) + 1 AS INT) AS pos"))
    aggs = ["count(1) AS _present"] + [f"max(pos = {k}) AS _has{k}" for k in range(1, spb + 1)]
    for k in range(1, spb + 1):
        for src, dst in ((num_name, "n"), ("num_nurses", "s"), ("ratio", "r"), ("norm", "u")):
            aggs.append(f"max(CASE WHEN pos = {k} THEN {src} END) AS _{dst}{k}")
    g = merged.groupBy(C.UNIT, "block").agg(*[F.expr(a) for a in aggs])
    ks = range(1, spb + 1)
    cols = [C.UNIT, f"{slot_start_sql('block', grid, grid.block_us)} AS {C.B12}"]
    cols += [f"CAST(coalesce(_n{k}, 0) AS BIGINT) AS {num_prefix}_{k}" for k in ks]
    cols += [f"CAST(coalesce(_s{k}, 0) AS BIGINT) AS {staff_prefix}_{k}" for k in ks]
    cols += [f"coalesce(_r{k}, 0D) AS {ratio_prefix}_{k}" for k in ks]
    # a missing slot is 0; a present slot keeps its (possibly NULL = NaN) norm
    present = "_present >= {k}" if slot_mode == "positional" else "_has{k}"
    cols += [f"CASE WHEN {present.format(k=k)} THEN _u{k} ELSE 0D END AS UNIT_NORM_RATIO_4HR_{k}" for k in ks]
    out = g.selectExpr(*cols)
    return out.selectExpr(
        "*", f"{mean_skip_null_sql(*[f'{ratio_prefix}_{k}' for k in ks])} AS {avg_name}",
        f"{mean_skip_null_sql(*[f'UNIT_NORM_RATIO_4HR_{k}' for k in ks])} AS AVG_UNIT_NORM_RATIO")


def _distinct(cohort: DataFrame, staff: DataFrame, count_mode: str) -> tuple[DataFrame, DataFrame]:
    """``count_mode='rows'`` (reference parity) counts cohort and assignment rows;
    ``'distinct'`` counts each stay once (not once per code) and each shift of a
    caregiver in a unit once (not once per admission)."""
    if count_mode == "rows":
        return cohort, staff
    if count_mode != "distinct":
        raise ValueError(f"count_mode must be 'rows' or 'distinct', not {count_mode!r}")
    return (cohort.dropDuplicates([C.SUBJECT_ID, C.HADM_ID, C.UNIT, C.ADMIT, C.DISCHARGE]),
            staff.dropDuplicates([C.UNIT, C.CGID, C.START, C.END]))


def discharge_to_nurse_ratio(cohort: DataFrame, staff: DataFrame, grid: GridSpec,
                             slot_mode: str = "positional", count_mode: str = "rows") -> DataFrame:
    """O5 from the cohort stays and the staff shifts (both unexpanded)."""
    cohort, staff = _distinct(cohort, staff, count_mode)
    return unit_block_ratio(
        tb.discharge_slots(cohort, grid), _staff_per_sub(staff, grid), grid, slot_mode=slot_mode,
        num_name="num_discharged", ratio_sql=ratio_or_zero_sql("num_discharged", "num_nurses"),
        num_prefix="DISCHARGE_4HR", ratio_prefix="DISCHARGE_NURSE_RATIO_4HR",
        avg_name="AVG_DISCHARGE_TO_NURSE_RATIO")


def nurse_to_patient_ratio(cohort: DataFrame, staff: DataFrame, grid: GridSpec,
                           slot_mode: str = "positional", count_mode: str = "rows") -> DataFrame:
    """Nurses per patient present; a count of 0 patients reads as 1."""
    cohort, staff = _distinct(cohort, staff, count_mode)
    return unit_block_ratio(
        tb.stay_sub_coverage(cohort, grid), _staff_per_sub(staff, grid), grid, slot_mode=slot_mode,
        num_name="num_patients", ratio_sql=ratio_or_zero_sql("num_nurses", "num_patients"), num_zero_as=1,
        num_prefix="PATIENTS_4HR", ratio_prefix="NURSE_TO_PATIENT_RATIO_4HR",
        avg_name="AVG_NURSE_TO_PATIENT_RATIO")
