"""O2 cohort selection and O3 staff assignments (the reference's two SQL queries)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardflow import config as C
from wardflow.config import CohortSpec
from wardflow.functions.match import code_filter, contains_ci
from wardflow.functions.timegrid import truncate_to_second
from wardflow.operators.labs import label_labs

COHORT_COLUMNS = [C.SUBJECT_ID, C.HADM_ID, C.ICD9_CODE, C.ICD_DESCRIPTION, C.UNIT, C.ADMIT, C.DISCHARGE]


def latest_discharge(transfers: DataFrame, spec: CohortSpec = CohortSpec()) -> DataFrame:
    """A1: latest discharge event per (subject, admission)."""
    return (transfers.where(F.col("EVENTTYPE") == spec.discharge_event)
            .groupBy(C.SUBJECT_ID, C.HADM_ID).agg(F.max("INTIME").alias(C.DISCHARGE)))


def tested_admissions(labs: DataFrame, pattern: str, dictionary: DataFrame | None = None) -> DataFrame:
    """Distinct admissions with at least one test whose label matches."""
    lab = label_labs(labs.select(C.SUBJECT_ID, C.HADM_ID, C.LABEL if dictionary is None else C.ITEMID), dictionary)
    return lab.where(contains_ci(F.col(C.LABEL), pattern)).select(C.SUBJECT_ID, C.HADM_ID).distinct()


def select_cohort(diagnoses: DataFrame, icd_dictionary: DataFrame, transfers: DataFrame,
                  labs: DataFrame, spec: CohortSpec = CohortSpec(),
                  lab_dictionary: DataFrame | None = None, ordered: bool = True) -> DataFrame:
    """O2: admissions of the month with a qualifying code and a required test.

    One row per distinct (subject, admission, code, title, unit, admit,
    discharge): a stay with two qualifying codes appears twice, as in the
    reference.  The month test is a half-open range on the raw time so it
    reaches the scan; the required-test join is a semi join.
    """
    titles = icd_dictionary.select(C.ICD9_CODE, F.col("LONG_TITLE").alias(C.ICD_DESCRIPTION))
    admits = (transfers.where((F.col("EVENTTYPE") == spec.admit_event)
                              & (F.col("INTIME") >= F.lit(spec.month_start).cast("timestamp_ntz"))
                              & (F.col("INTIME") < F.lit(spec.month_end).cast("timestamp_ntz")))
              .select(C.SUBJECT_ID, C.HADM_ID, C.UNIT, truncate_to_second("INTIME").alias(C.ADMIT)))
    # The month's admissions restrict every other input first.  The semi join
    # is on the admission alone, so it moves below joins that attach the
    # subject and reaches the large tables before they are shuffled.
    month = admits.select(C.HADM_ID).distinct()

    def in_month(df: DataFrame) -> DataFrame:
        return df.join(month, C.HADM_ID, "left_semi")

    d = in_month(diagnoses.where(code_filter(F.col(C.ICD9_CODE), spec.code_prefixes, spec.code_equals)))
    d = d.select(C.SUBJECT_ID, C.HADM_ID, C.ICD9_CODE).join(titles, C.ICD9_CODE, "left")
    cand = d.join(admits, [C.SUBJECT_ID, C.HADM_ID], "inner")
    ends = latest_discharge(in_month(transfers), spec)
    tested = tested_admissions(in_month(labs), spec.required_lab_pattern, lab_dictionary)
    out = (cand.join(ends, [C.SUBJECT_ID, C.HADM_ID], "left")
           .join(tested, [C.SUBJECT_ID, C.HADM_ID], "left_semi")
           .select(C.SUBJECT_ID, C.HADM_ID, C.ICD9_CODE, C.ICD_DESCRIPTION, C.UNIT, C.ADMIT,
                   truncate_to_second(C.DISCHARGE).alias(C.DISCHARGE))
           .distinct())
    return out.orderBy(C.SUBJECT_ID, C.ADMIT) if ordered else out


def cohort_subject_count(cohort: DataFrame) -> DataFrame:
    """Distinct subjects, a null subject counting as one value (pandas ``unique``)."""
    any_null = F.coalesce(F.max(F.col(C.SUBJECT_ID).isNull().cast("int")), F.lit(0))
    return cohort.agg((F.count_distinct(C.SUBJECT_ID) + any_null).cast("bigint").alias("N_SUBJECTS"))


def staff_assignments(transfers: DataFrame, team: DataFrame, caregivers: DataFrame,
                      spec: CohortSpec = CohortSpec()) -> DataFrame:
    """O3: distinct (unit, admission, caregiver, label, start, end) of staff
    whose label matches ``spec.staff_label_pattern``.

    The admission's units are made distinct before the fan-out join, so the
    join emits each output pair once instead of once per transfer row; only admissions with
    matching staff get that far.
    """
    cg = caregivers.where(contains_ci(F.col(C.LABEL), spec.staff_label_pattern)).select(C.CGID, C.LABEL)
    tm = team.select(C.HADM_ID, C.CGID, C.START, C.END).join(cg, C.CGID, "inner")
    staffed = team.join(cg, C.CGID, "left_semi").select(C.HADM_ID).distinct()
    units = transfers.where(F.col(C.HADM_ID).isNotNull()).join(staffed, C.HADM_ID, "left_semi").select(C.HADM_ID, C.UNIT).distinct()
    j = units.join(tm, C.HADM_ID, "inner")
    return j.select(C.UNIT, C.HADM_ID, C.CGID, C.LABEL,
                    truncate_to_second(C.START).alias(C.START),
                    truncate_to_second(C.END).alias(C.END)).distinct()
