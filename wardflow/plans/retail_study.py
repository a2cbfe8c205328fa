"""The whole study over the retail view of the driver's tables, from O2 and O3 on."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from wardflow.config import JUNE_2000, GridSpec
from wardflow.operators import cohort as K
from wardflow.plans.study import Study
from wardflow.session import file_stamp
from wardflow.sources import retail_view as rv
from wardflow.sources.schemas import CLINICAL_DDL
from wardflow.sources.tables import Tables, typed_times

# Fixed values of the retail mapping: item names standing for the two tests.
TESTS = (("RETURNED", "R"), ("ACCEPTED", "A"))


class RetailStudy(Study):
    """Stays are the cohort's rows (one per qualifying code), staff the O3 rows, tests named by a dictionary."""

    tests = TESTS

    def __init__(self, spark: SparkSession, sf_dir: str, spec=rv.RETAIL_SPEC, grid: GridSpec = JUNE_2000):
        self.t = Tables(spark, sf_dir)
        self.spec = spec
        self.grid = grid
        self.lab_dictionary = rv.lab_dictionary(self.t)

    def fingerprint(self) -> str:
        tables = ("orders", "lineitem", "part", "customer", "supplier")
        stamps = [file_stamp(self.t.spark, f"{self.t.sf_dir.rstrip('/')}/{n}.parquet") for n in tables]
        return f"{type(self).__name__} {stamps} {self.grid} {self.tests} {self.spec}"

    def select_cohort(self, ordered: bool = True) -> DataFrame:
        t = self.t
        return K.select_cohort(rv.diagnoses(t), rv.icd_dictionary(t), rv.transfers(t), rv.labs(t),
                               self.spec, self.lab_dictionary, ordered)

    @cached_property
    def stays(self) -> DataFrame:
        return self.select_cohort(ordered=False)

    @cached_property
    def staff(self) -> DataFrame:
        return self.staff_assignments()

    @cached_property
    def labs(self) -> DataFrame:
        return rv.labs(self.t)

    def latest_discharge(self) -> DataFrame:
        return K.latest_discharge(rv.transfers(self.t), self.spec)

    def tested_admissions(self) -> DataFrame:
        return K.tested_admissions(rv.labs(self.t), self.spec.required_lab_pattern, self.lab_dictionary)

    def subject_count(self) -> DataFrame:
        return K.cohort_subject_count(self.select_cohort())

    def staff_assignments(self) -> DataFrame:
        t = self.t
        return K.staff_assignments(rv.transfers(t), rv.treatment_team(t), rv.caregivers(t), self.spec)


class TextTimesRetailStudy(RetailStudy):
    """The retail study over sources that keep their times as text, some of them no times.

    Every input is parsed at the source: ``try_cast`` gives NULL for what is no time, and the
    stages treat it as any missing time.
    """

    def select_cohort(self, ordered: bool = True) -> DataFrame:
        t = self.t
        return K.select_cohort(rv.diagnoses(t), rv.icd_dictionary(t), self._transfers(), self._labs(),
                               self.spec, self.lab_dictionary, ordered)

    def _transfers(self) -> DataFrame:
        return typed_times(rv.as_text(rv.transfers(self.t), "INTIME"), CLINICAL_DDL["TRANSFERS"])

    def _labs(self) -> DataFrame:
        return typed_times(rv.as_text(rv.labs(self.t), "CHARTTIME"), CLINICAL_DDL["LABS"])

    @cached_property
    def labs(self) -> DataFrame:
        return self._labs()

    def staff_assignments(self) -> DataFrame:
        t = self.t
        team = typed_times(rv.as_text(rv.treatment_team(t), "STARTTIME", "ENDTIME"), CLINICAL_DDL["TREATMENT_TEAM"])
        return K.staff_assignments(self._transfers(), team, rv.caregivers(t), self.spec)
