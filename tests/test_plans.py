"""Physical-plan guards over every registered query (sf0.001)."""

from __future__ import annotations

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython")
EAGER = {"cohort_run_metrics", "retail_run_metrics", "resumed_run_metrics", "csv_roundtrip", "profile_duplicates",
         "discovered_keys", "discovered_references", "incremental_nulls", "incremental_duplicates"}  # these write files while building


def test_no_nested_loop_cartesian_or_python_in_plans(spark):
    bad = {}
    for name, q in E.study_queries().items():
        if name in EAGER:
            continue
        plan = q(spark, SF)._jdf.queryExecution().executedPlan().toString()
        hits = [k for k in FORBIDDEN if k in plan]
        if hits:
            bad[name] = hits
    assert bad == {}
