"""Expected results of the hand-sized clinical fixture (FIXTURES.md section B)."""

from __future__ import annotations

import pytest

from tests.clinical_fixture import tables, ts
from wardflow.operators import profile as P
from wardflow.plans.clinical_study import ClinicalStudy


@pytest.fixture(scope="module")
def study(spark):
    return ClinicalStudy(tables(spark))


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def approx(x, n=6):
    return None if x is None else round(x, n)


def test_cohort(study):
    got = rows(study.stays, "SUBJECT_ID", "HADM_ID", "ICD9_CODE", "ICD_DESCRIPTION", "CURR_CAREUNIT",
               "DISCHARGE_DATE")
    assert got == sorted([
        (1, 101, "4254", "Prim cardiomyopathy", "CCU", ts("06-04 03:00")),
        (1, 101, "4280", "CHF NOS", "CCU", ts("06-04 03:00")),
        (1, 102, "42830", None, "CCU", ts("06-21 23:00")),
        (2, 201, "4299", "Heart disease NOS", "MICU", ts("06-10 23:00")),
        (3, 301, "78551", "Cardiogenic shock", "SICU", None),
        (5, 501, "4281", "Left heart failure", None, ts("06-06 04:00")),
        (8, 801, "4280", "CHF NOS", "MICU", ts("06-10 18:00")),
    ], key=repr)


def test_staff(study):
    got = rows(study.staff, "CURR_CAREUNIT", "HADM_ID")
    from collections import Counter
    assert Counter(got) == Counter({(None, 101): 3, (None, 201): 1, ("CCU", 101): 3, ("MICU", 101): 3,
                                    ("MICU", 201): 1, ("SICU", 301): 1})


def test_expansion(study):
    p = study.expanded_stays()
    assert p.count() == 51
    assert study.expanded_staff().count() == 36
    per = dict(((r["HADM_ID"], r["TIME_BLOCK_12HR"]), r["count"])
               for r in p.groupBy("HADM_ID", "TIME_BLOCK_12HR").count().collect())
    assert per[(101, ts("06-02 12:00"))] == 6 and per[(101, ts("06-04 00:00"))] == 6
    assert per[(102, ts("06-21 12:00"))] == 3 and per[(301, ts("06-30 00:00"))] == 3
    assert per[(501, ts("06-06 00:00"))] == 3 and per[(801, ts("06-10 12:00"))] == 3
    assert not any(h == 201 for h, _ in per)
    assert len(per) == 4 + 4 + 2 + 2 + 1


def test_discharge_ratio(study):
    d = {(r["CURR_CAREUNIT"], r["TIME_BLOCK_12HR"]): r for r in study.discharge_ratio().collect()}
    assert len(d) == 7
    r = d[("CCU", ts("06-04 00:00"))]
    assert (r["DISCHARGE_4HR_1"], r["DISCHARGE_4HR_2"], r["DISCHARGE_4HR_3"]) == (2, 0, 0)
    assert r["AVG_DISCHARGE_TO_NURSE_RATIO"] == 0 and r["AVG_UNIT_NORM_RATIO"] == 0
    r = d[("CCU", ts("06-03 00:00"))]
    assert (r["NURSES_4HR_1"], r["NURSES_4HR_2"], r["NURSES_4HR_3"]) == (2, 2, 2)
    assert r["AVG_UNIT_NORM_RATIO"] is None
    r = d[("MICU", ts("06-10 12:00"))]
    assert (r["DISCHARGE_4HR_1"], r["DISCHARGE_4HR_2"], r["DISCHARGE_4HR_3"]) == (0, 0, 1)
    assert approx(r["AVG_DISCHARGE_TO_NURSE_RATIO"]) == approx(1 / 3)
    assert approx(r["AVG_UNIT_NORM_RATIO"]) == 3.0
    assert d[("MICU", ts("06-03 00:00"))]["AVG_UNIT_NORM_RATIO"] == 0
    assert d[("SICU", ts("06-29 12:00"))]["AVG_UNIT_NORM_RATIO"] is None


def test_patient_ratio(study):
    d = {(r["CURR_CAREUNIT"], r["TIME_BLOCK_12HR"]): r for r in study.patient_ratio().collect()}
    assert len(d) == 13
    exp = {("CCU", "06-02 12:00"): ((2, 2, 2), 0, 0), ("CCU", "06-03 00:00"): ((2, 2, 2), 1, 4.888889),
           ("CCU", "06-03 12:00"): ((2, 2, 2), 0.5, 2.444444), ("CCU", "06-04 00:00"): ((2, 0, 0), 0, 0),
           ("CCU", "06-21 12:00"): ((1, 1, 1), 0, 0), ("MICU", "06-03 00:00"): ((1, 1, 1), 2, 1.5),
           ("MICU", "06-03 12:00"): ((1, 1, 1), 1, 0.75), ("MICU", "06-10 12:00"): ((1, 1, 1), 1, 0.75),
           ("SICU", "06-29 12:00"): ((1, 1, 1), 1, 2), ("SICU", "06-30 00:00"): ((1, 1, 1), 0, 0)}
    for (u, b), (pats, avg, norm) in exp.items():
        r = d[(u, ts(b))]
        assert (r["PATIENTS_4HR_1"], r["PATIENTS_4HR_2"], r["PATIENTS_4HR_3"]) == pats, (u, b)
        assert approx(r["AVG_NURSE_TO_PATIENT_RATIO"]) == approx(avg), (u, b)
        assert approx(r["AVG_UNIT_NORM_RATIO"]) == approx(norm), (u, b)


def test_lab_subset(study):
    df = study.lab_subset()
    assert df.count() == 12
    assert df.distinct().count() == 8


def test_latest_lab(study):
    t = {(r["HADM_ID"], r["TIME_BLOCK_12HR"]): (r["TROPONIN_VAL"], r["TROPONIN_UNIT"])
         for r in study.latest_lab("TROPONIN").collect()}
    assert len(t) == 13
    assert t[(101, ts("06-02 12:00"))] == (None, None)
    assert t[(101, ts("06-03 00:00"))] == (0.5, "ng/mL")
    assert t[(101, ts("06-03 12:00"))] == (0.5, "ng/ml")
    assert t[(101, ts("06-04 00:00"))] == (0.5, "ng/ml")
    assert t[(102, ts("06-21 00:00"))] == (None, None)
    assert t[(102, ts("06-21 12:00"))] == (0.04, "ng/ml")
    assert t[(301, ts("06-29 12:00"))] == (None, None)
    assert t[(801, ts("06-10 12:00"))] == (None, None)
    assert t[(501, ts("06-05 12:00"))] == (2.5, "ng/mL") == t[(501, ts("06-06 00:00"))]
    b = {(r["HADM_ID"], r["TIME_BLOCK_12HR"]): (r["BNP_VAL"], r["BNP_UNIT"])
         for r in study.latest_lab("BNP").collect()}
    assert b[(101, ts("06-02 12:00"))] == (None, None)
    assert b[(101, ts("06-03 00:00"))] == (800.0, "pg/mL") == b[(101, ts("06-04 00:00"))]
    assert sum(v != (None, None) for v in b.values()) == 3


def test_latest_per_subject(study):
    t = dict((r["SUBJECT_ID"], (r["TROPONIN_VAL"], r["TROPONIN_UNIT"]))
             for r in study.latest_per_subject("TROPONIN").collect())
    assert t == {1: (0.04, "ng/ml"), 3: (None, None), 5: (2.5, "ng/mL"), 8: (None, None)}
    b = study.latest_per_subject("BNP").collect()
    assert len(b) == 4 and all(r["BNP_VAL"] is None for r in b)


def test_observations(study):
    o = {(r["HADM_ID"], r["TIME_BLOCK_12HR"]): r for r in study.observations().collect()}
    assert len(o) == 13
    r = o[(101, ts("06-03 00:00"))]
    assert r["CURR_CAREUNIT"] == "CCU" and r["AVG_DISCHARGE_TO_NURSE_RATIO"] == 0
    assert r["AVG_NURSE_TO_PATIENT_RATIO"] == 1
    assert (r["TROPONIN_VAL"], r["TROPONIN_UNIT"], r["BNP_VAL"], r["BNP_UNIT"]) == (0.5, "ng/mL", 800.0, "pg/mL")
    r = o[(801, ts("06-10 12:00"))]
    assert approx(r["AVG_DISCHARGE_TO_NURSE_RATIO"]) == approx(1 / 3) and r["AVG_NURSE_TO_PATIENT_RATIO"] == 1
    assert r["TROPONIN_VAL"] is None and r["BNP_VAL"] is None
    r = o[(501, ts("06-05 12:00"))]
    assert r["AVG_DISCHARGE_TO_NURSE_RATIO"] is None and r["AVG_NURSE_TO_PATIENT_RATIO"] is None


def test_block_counts(study):
    n = {(r["CURR_CAREUNIT"], r["TIME_BLOCK_12HR"]): r["NURSE_COUNT"] for r in study.staff_block_counts().collect()}
    assert n == {("CCU", ts("06-03 00:00")): 6, ("CCU", ts("06-03 12:00")): 3, ("MICU", ts("06-03 00:00")): 6,
                 ("MICU", ts("06-03 12:00")): 3, ("MICU", ts("06-10 12:00")): 3, ("SICU", ts("06-29 12:00")): 3}
    s = {(r["CURR_CAREUNIT"], r["TIME_BLOCK_12HR"]): r["SUBJECT_COUNT"]
         for r in study.subject_block_counts().collect()}
    assert s[("CCU", ts("06-02 12:00"))] == 6 and s[("CCU", ts("06-20 00:00"))] == 3
    assert s[("MICU", ts("06-10 12:00"))] == 3 and s[("SICU", ts("06-30 00:00"))] == 3
    assert len(s) == 8 + 1 + 2


def test_last_unit_and_counts(study):
    lu = {r["HADM_ID"]: r for r in study.last_unit_labs().collect()}
    assert set(lu) == {101, 102, 301, 501, 801}
    assert lu[101]["CURR_CAREUNIT"] == "CCU" and lu[101]["TROPONIN_VAL"] == 0.04
    assert lu[501]["CURR_CAREUNIT"] is None and lu[501]["TROPONIN_VAL"] == 2.5
    c = {r["CURR_CAREUNIT"]: (r["PATIENT_COUNT"], r["Troponin_Count"], r["BNP_Count"])
         for r in study.tested_counts_by_unit().collect()}
    assert c == {"CCU": (2, 2, 0), "MICU": (1, 0, 0), "SICU": (1, 0, 0)}


def test_profile(spark):
    t = tables(spark)
    got = {(r["TABLE_NAME"], r["COLUMN_NAME"]): r["NULL_COUNT"] for r in P.profile_nulls(t).collect()}
    assert got == {("TRANSFERS", "CURR_CAREUNIT"): 8, ("TRANSFERS", "PREV_CAREUNIT"): 16,
                   ("TRANSFERS", "OUTTIME"): 16, ("CARE_GIVERS", "LABEL"): 1,
                   ("CARE_GIVERS", "DESCRIPTION"): 4, ("LABS", "VALUENUM"): 1, ("ICD_LABS", "LOINC_CODE"): 4}
    d = P.profile_duplicates(t).collect()
    assert len(d) == 7 and all(r["DUPLICATE_ROWS"] == 0 for r in d)
    assert all(r["PRIMARY_KEYS"] == "None" for r in d)


def test_cohort_run_writes_every_stage(spark):
    from wardflow.plans.cohort_run import run_study
    from wardflow.sources.commit import read_output
    study = ClinicalStudy(tables(spark))
    out_dir, metrics = run_study(study, spark)
    got = {r["STAGE"]: r["ROW_COUNT"] for r in metrics.collect()}
    assert got == {"cohort": study.stays.count(), "staff_assignments": study.staff.count(), "expanded_patients": 51, "expanded_nurses": 36, "discharge_ratio": 7, "patient_ratio": 13,
                   "labs_subset": 12, "lab_results_troponin": 13, "lab_results_bnp": 13,
                   "latest_troponin": 4, "latest_bnp": 4, "observations": 13}
    back = read_output(spark, out_dir, "latest_troponin")
    assert {r["SUBJECT_ID"]: r["TROPONIN_VAL"] for r in back.collect()}[1] == 0.04


def test_clock_slots_and_distinct_counts(study):
    from wardflow.operators import ratios as R
    d = {(r["CURR_CAREUNIT"], r["TIME_BLOCK_12HR"]): r
         for r in R.discharge_to_nurse_ratio(study.cohort, study.shifts, study.grid, slot_mode="clock").collect()}
    r = d[("CCU", ts("06-04 00:00"))]   # the only present row is 04:00: clock slot 2
    assert (r["DISCHARGE_4HR_1"], r["DISCHARGE_4HR_2"], r["DISCHARGE_4HR_3"]) == (0, 2, 0)
    assert r["UNIT_NORM_RATIO_4HR_1"] == 0 and r["UNIT_NORM_RATIO_4HR_2"] is None
    u = {(r["CURR_CAREUNIT"], r["TIME_BLOCK_12HR"]): r
         for r in R.discharge_to_nurse_ratio(study.cohort, study.shifts, study.grid, count_mode="distinct").collect()}
    assert u[("CCU", ts("06-04 00:00"))]["DISCHARGE_4HR_1"] == 1   # stay 101 once, not once per code
    p = {(r["CURR_CAREUNIT"], r["TIME_BLOCK_12HR"]): r
         for r in R.nurse_to_patient_ratio(study.cohort, study.shifts, study.grid, count_mode="distinct").collect()}
    assert p[("CCU", ts("06-03 00:00"))]["PATIENTS_4HR_1"] == 1
