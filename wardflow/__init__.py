"""wardflow — cohort and time-block analytics as lazy Spark DataFrame plans.

Every operator is a plain function ``DataFrame -> DataFrame`` built from
built-in Spark expressions, so Catalyst/AQE choose the physical plan.
"""

from wardflow.config import GridSpec, CohortSpec, LabSpec  # noqa: F401

__all__ = ["GridSpec", "CohortSpec", "LabSpec"]
