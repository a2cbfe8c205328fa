"""One observation row per admission and 12 h block."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardflow import config as C
from wardflow.config import GridSpec
from wardflow.functions.timegrid import slot_start
from wardflow.operators import labs as L, ratios as R
from wardflow.operators.timeblocks import _FIRST, _LAST, with_block_range


def admission_blocks(cohort: DataFrame, grid: GridSpec) -> DataFrame:
    """Distinct (SUBJECT_ID, HADM_ID, CURR_CAREUNIT, block index _k) of the expansion."""
    r = with_block_range(cohort, C.ADMIT, C.DISCHARGE, grid)
    return r.select(C.SUBJECT_ID, C.HADM_ID, C.UNIT,
                    F.expr(f"explode(sequence({_FIRST}, {_LAST}))").alias("_k")).distinct()


def assemble(blocks: DataFrame, timelines: DataFrame, o5: DataFrame, o6: DataFrame, grid: GridSpec,
             tests=(("TROPONIN", "Troponin"), ("BNP", "BNP"))) -> DataFrame:
    """Attach the latest tests of the stay and both ratio summaries of the unit to each admission block."""
    d = o5.select(C.UNIT, C.B12, "AVG_DISCHARGE_TO_NURSE_RATIO",
                  F.col("AVG_UNIT_NORM_RATIO").alias("DISCHARGE_UNIT_NORM_RATIO"))
    p = o6.select(C.UNIT, C.B12, "AVG_NURSE_TO_PATIENT_RATIO",
                  F.col("AVG_UNIT_NORM_RATIO").alias("PATIENT_UNIT_NORM_RATIO"))
    labs = [f"{prefix}_{c}" for prefix, _ in tests for c in ("VAL", "UNIT")]
    tested = blocks.join(timelines.select(C.SUBJECT_ID, C.HADM_ID, "_seen"), [C.SUBJECT_ID, C.HADM_ID], "left").select(
        C.SUBJECT_ID, C.HADM_ID, C.UNIT, slot_start("_k", grid, grid.block_us).alias(C.B12), *L.values_at("_k", tuple(tests)))
    out = tested.join(d, [C.UNIT, C.B12], "left").join(p, [C.UNIT, C.B12], "left")
    return out.select(C.SUBJECT_ID, C.HADM_ID, C.UNIT, C.B12, "AVG_DISCHARGE_TO_NURSE_RATIO",
                      "DISCHARGE_UNIT_NORM_RATIO", "AVG_NURSE_TO_PATIENT_RATIO", "PATIENT_UNIT_NORM_RATIO", *labs)


def observations(cohort: DataFrame, staff: DataFrame, labs: DataFrame, grid: GridSpec,
                 tests=(("TROPONIN", "Troponin"), ("BNP", "BNP")),
                 lab_dictionary: DataFrame | None = None) -> DataFrame:
    """Both ratios of the unit's block and every test's latest value.

    The tests meet the blocks by (subject, admission), without an exchange where the inputs are
    bucketed by them.  The ratio tables have at most units x blocks rows; the planner (AQE)
    broadcasts them by their measured size.  A null unit keeps the row with null ratios.
    """
    subset = L.subset_labs(cohort, labs, tuple(name for _, name in tests), lab_dictionary)
    return assemble(admission_blocks(cohort, grid), L.stay_timelines(cohort, subset, grid, tuple(tests)),
                    R.discharge_to_nurse_ratio(cohort, staff, grid),
                    R.nurse_to_patient_ratio(cohort, staff, grid), grid, tests)
