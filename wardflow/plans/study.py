"""Shared plan of the study: every stage as a lazy DataFrame.

Subclasses supply the three inputs — cohort stays, staff shifts and lab
rows — and the tests to follow; the stages are the same for the clinical
tables and for the views onto the driver's tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardflow import config as C

from wardflow.config import GridSpec
from wardflow.operators import chartdata as V, labs as L, observations as O, ordering as T
from wardflow.operators import ratios as R, summaries as S, timeblocks as tb


class Study:
    grid: GridSpec
    tests: tuple[tuple[str, str], ...]   # (column prefix, label pattern)
    count_names: dict[str, str] = {}     # O15 column by prefix; else the test's name and _Count
    lab_dictionary: DataFrame | None = None
    stays: DataFrame
    staff: DataFrame
    labs: DataFrame
    input_rows: dict[str, int] = {}      # rows of the inputs that are written already

    def fingerprint(self) -> str:
        """Names the study's inputs and parameters: equal for runs that would write equal stages."""
        frames = [df.semanticHash() for df in (self.stays, self.staff, self.labs)]
        return f"{type(self).__name__} {frames} {self.grid} {self.tests}"

    @property
    def cohort(self) -> DataFrame:
        return self.stays

    @property
    def shifts(self) -> DataFrame:
        return self.staff

    # --- O4-O9 ---

    def expanded_stays(self) -> DataFrame:
        return tb.expand_stays(self.cohort, self.grid)

    def expanded_staff(self) -> DataFrame:
        return tb.expand_staff(self.shifts, self.grid)

    def discharge_ratio(self) -> DataFrame:
        return R.discharge_to_nurse_ratio(self.cohort, self.shifts, self.grid)

    def patient_ratio(self) -> DataFrame:
        return R.nurse_to_patient_ratio(self.cohort, self.shifts, self.grid)

    def lab_subset(self) -> DataFrame:
        return L.subset_labs(self.cohort, self.labs, tuple(n for _, n in self.tests), self.lab_dictionary)

    def latest_lab(self, prefix: str) -> DataFrame:
        return L.latest_lab(self.cohort, self.lab_subset(), self.grid, dict(self.tests)[prefix], prefix)

    def latest_per_subject(self, prefix: str) -> DataFrame:
        return L.latest_per_subject(self.cohort, self.lab_subset(), self.grid, dict(self.tests)[prefix], prefix)

    # --- O11-O15 ---

    def observations(self) -> DataFrame:
        return O.observations(self.cohort, self.shifts, self.labs, self.grid, self.tests, self.lab_dictionary)

    def staff_block_counts(self) -> DataFrame:
        return S.staff_block_counts(self.shifts, self.grid)

    def subject_block_counts(self) -> DataFrame:
        return S.subject_block_counts(self.cohort, self.grid)

    def last_unit_labs(self) -> DataFrame:
        latest = L.latest_per_subject_all(self.cohort, self.lab_subset(), self.grid, tuple(self.tests))
        return S.last_unit_with_labs(self.cohort, self.grid, {"tests": latest})

    def tested_counts_by_unit(self) -> DataFrame:
        return S.tested_counts_by_unit(self.last_unit_labs(),
                                       {f"{p}_VAL": self.count_names.get(p, f"{name}_Count")
                                        for p, name in self.tests})

    # --- F17, F18, T4, T5 ---

    def subject_lookup(self, subject_id: int) -> DataFrame:
        """one subject's last units and latest tests."""
        return self.last_unit_labs().where(F.col("SUBJECT_ID") == subject_id)

    def unit_labels(self, prefix: str) -> DataFrame:
        """each distinct unit of the per-subject latest test (null included), with rows and non-null values."""
        d = self.latest_per_subject(prefix)
        return d.groupBy(F.col(f"{prefix}_UNIT").alias("UNIT_LABEL")).agg(
            F.count(F.lit(1)).alias("N_SUBJECTS"), F.count(f"{prefix}_VAL").alias("N_VALUES"))

    def head_rows(self, n: int = 5) -> DataFrame:
        return T.head_rows(self.observations(), ["SUBJECT_ID", "HADM_ID", "TIME_BLOCK_12HR"], n)

    def slice_rows(self, start: int = 10, stop: int = 16) -> DataFrame:
        return T.slice_rows(self.discharge_ratio(), ["CURR_CAREUNIT", "TIME_BLOCK_12HR"], start, stop)

    def slice_deep(self, share: float = 0.9, n: int = 100) -> DataFrame:
        """T5 at depth: ``n`` observations from the position at ``share`` of all rows on."""
        return T.slice_from_share(self.observations(), ["SUBJECT_ID", "HADM_ID", "TIME_BLOCK_12HR", "CURR_CAREUNIT"], share, n)

    # --- V1-V6 (first and second test stand in for Troponin and BNP) ---

    @property
    def _p1(self) -> str:
        return self.tests[0][0]

    @property
    def _p2(self) -> str:
        return self.tests[-1][0]

    def chart_scatter(self) -> DataFrame:
        return V.scatter_points(self.discharge_ratio(), "TIME_BLOCK_12HR", "AVG_DISCHARGE_TO_NURSE_RATIO",
                                hue="CURR_CAREUNIT")

    def chart_scatter_sample(self, per_hue: int = 40) -> DataFrame:
        return V.scatter_points(self.observations(), "TIME_BLOCK_12HR", "AVG_NURSE_TO_PATIENT_RATIO", hue="CURR_CAREUNIT",
                                per_hue=per_hue, sample_key=["SUBJECT_ID", "HADM_ID", "TIME_BLOCK_12HR"])

    def chart_box(self) -> DataFrame:
        return V.box_stats(self.patient_ratio(), "CURR_CAREUNIT", "AVG_NURSE_TO_PATIENT_RATIO",
                           hue="CURR_CAREUNIT")

    def chart_bar(self) -> DataFrame:
        return V.group_stats(self.last_unit_labs(), "CURR_CAREUNIT", f"{self._p1}_VAL", hue="CURR_CAREUNIT")

    def chart_line(self) -> DataFrame:
        return V.group_stats(self.observations(), "TIME_BLOCK_12HR", f"{self._p1}_VAL", hue="CURR_CAREUNIT")

    def chart_hist(self) -> DataFrame:
        return V.histogram(self.latest_per_subject(self._p1), f"{self._p1}_VAL", 50)

    def chart_density(self) -> DataFrame:
        return V.density(self.latest_per_subject(self._p1), f"{self._p1}_VAL")

    def chart_facet_scatter(self) -> DataFrame:
        return V.scatter_points(self.patient_ratio(), "TIME_BLOCK_12HR", "AVG_NURSE_TO_PATIENT_RATIO",
                                facet="CURR_CAREUNIT")

    def chart_facet_line(self) -> DataFrame:
        return V.group_stats(self.observations(), "TIME_BLOCK_12HR", f"{self._p2}_VAL", facet="CURR_CAREUNIT")

    def chart_facet_box(self) -> DataFrame:
        return V.box_stats(self.observations(), "TIME_BLOCK_12HR", f"{self._p1}_VAL", facet="CURR_CAREUNIT")

    def chart_facet_hist(self) -> DataFrame:
        return V.histogram(self.observations(), f"{self._p1}_VAL", 30, by=["CURR_CAREUNIT"])

    def chart_facet_density(self) -> DataFrame:
        return V.density(self.observations(), f"{self._p1}_VAL", by=["CURR_CAREUNIT"])

    # --- S9-S11 ---

    def stage_metrics(self) -> DataFrame:
        """S11 (query form): rows of every stage, without writing any; a run counts them while it writes."""
        from wardflow.plans.metrics import stage_counts
        tests = tuple(self.tests)
        values = L.block_values(L.stay_timelines(self.cohort, self.lab_subset(), self.grid, tests), self.grid, tests)
        latest = L.pick_latest_per_subject(values, tests)
        return stage_counts({"cohort": self.stays.select("HADM_ID"), "staff_assignments": self.staff.select("CGID"),
                             "expanded_patients": self.expanded_stays(),
                             "expanded_nurses": self.expanded_staff(),
                             "discharge_ratio": self.discharge_ratio(),
                             "patient_ratio": self.patient_ratio(),
                             "labs_subset": self.lab_subset(),
                             **{f"lab_results_{p.lower()}": values for p, _ in tests},
                             **{f"latest_{p.lower()}": latest for p, _ in tests},
                             "observations": self.observations()})

    def csv_roundtrip(self) -> DataFrame:
        """Write the discharge ratio as CSV to a fresh shared folder, twice, read it back."""
        from wardflow.session import shared_dir
        from wardflow.sources.sinks import read_stage, write_stage
        spark = self.cohort.sparkSession
        df = self.discharge_ratio()
        path = shared_dir(spark, "wardflow-csv")
        write_stage(self.subject_block_counts(), path, "csv")
        write_stage(df, path, "csv")  # a second write replaces the first (S10)
        return read_stage(spark, path, df.schema, "csv")
