"""The reference's study on the clinical tables (TRANSFERS, LABS, ...)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from wardflow.config import JUNE_2000, CohortSpec, GridSpec, LabSpec
from wardflow.operators import cohort as K
from wardflow.plans.study import Study
from wardflow.sources.schemas import CLINICAL_DDL
from wardflow.sources.tables import typed_times


class ClinicalStudy(Study):
    """Stages over a ``{TABLE: DataFrame}`` map of the eight clinical tables."""

    def __init__(self, tables: dict[str, DataFrame], grid: GridSpec = JUNE_2000,
                 spec: CohortSpec = CohortSpec(), labs: LabSpec = LabSpec()):
        self.tables = {n: typed_times(t, CLINICAL_DDL[n]) if n in CLINICAL_DDL else t for n, t in tables.items()}
        self.grid = grid
        self.spec = spec
        self.tests = tuple(labs.tests.items())
        self.lab_dictionary = tables["ICD_LABS"]

    @cached_property
    def stays(self) -> DataFrame:
        """O2 cohort rows (one per qualifying code)."""
        t = self.tables
        return K.select_cohort(t["DIAGNOSES"], t["ICD_DIAGNOSES"], t["TRANSFERS"], t["LABS"], self.spec,
                               lab_dictionary=t["ICD_LABS"], ordered=False)

    @cached_property
    def staff(self) -> DataFrame:
        """O3 staff assignments."""
        t = self.tables
        return K.staff_assignments(t["TRANSFERS"], t["TREATMENT_TEAM"], t["CARE_GIVERS"], self.spec)

    @cached_property
    def labs(self) -> DataFrame:
        return self.tables["LABS"]
