"""Output is swapped at once, and a stopped run goes on where it stopped."""

from __future__ import annotations

import pytest

from tests.clinical_fixture import tables
from wardflow.plans.clinical_study import ClinicalStudy
from wardflow.plans.cohort_run import resumed_run, run_study
from wardflow.plans.retail_study import RetailStudy
from wardflow.session import shared_dir
from wardflow.sources.commit import MANIFEST, StagedRun, output, read_output

SF = "/root/testdata/sf0.001"


def _rows(spark, out):
    return {n: sorted(map(str, s.read(spark).collect())) for n, s in output(spark, out).items()}


class Stop(Exception):
    pass


def _stop_after(n):
    seen = []

    def hook(name):
        seen.append(name)
        if len(seen) == n:
            raise Stop
    return hook


@pytest.mark.parametrize("parallel", [1, 4])
def test_stopped_run_leaves_the_old_output(spark, parallel):
    study = ClinicalStudy(tables(spark))
    out, first = run_study(study, spark)
    old = _rows(spark, out)
    assert set(old) == {r.STAGE for r in first.collect()} - {"cohort", "staff_assignments"}
    fewer = dict(tables(spark))
    fewer["TRANSFERS"] = fewer["TRANSFERS"].where("HADM_ID <> 101")
    changed = ClinicalStudy(fewer)
    with pytest.raises(Stop):
        run_study(changed, spark, out, parallel=parallel, on_stage=_stop_after(7))
    assert _rows(spark, out) == old  # whole and unchanged
    before = set(StagedRun(spark, out, f"{changed.fingerprint()} csv").resumed)
    assert len(before) >= 7
    written = []
    run_study(changed, spark, out, on_stage=written.append)
    assert not before & set(written) and len(before) + len(written) == 13  # 12 stages and the timelines
    assert _rows(spark, out) == _rows(spark, run_study(changed, spark)[0]) != old
    # folders of earlier runs and tables that only served the run are gone
    run = StagedRun(spark, out, "another")
    assert run.folder.names(f"runs/{run.committed}/_done") == sorted(f"{n}.json" for n in old)
    assert run.folder.names("runs") == sorted([run.committed, run.run])


def test_other_inputs_start_a_new_run(spark):
    out = shared_dir(spark, "commit-test")
    one = StagedRun(spark, out, "a")
    one.write("x", spark.range(3))
    assert StagedRun(spark, out, "b").run != one.run and StagedRun(spark, out, "a").run == one.run
    with pytest.raises(RuntimeError, match="y"):
        one.commit(["x", "y"])
    assert output(spark, out) == {}  # no manifest yet
    one.commit(["x"])
    assert read_output(spark, out, "x").count() == 3 and output(spark, out)["x"].rows == 3
    # the same inputs again: a new run, and the committed one stays until it is complete
    again = StagedRun(spark, out, "a")
    assert again.run != one.run and not again.resumed
    again.write("x", spark.range(5))
    assert read_output(spark, out, "x").count() == 3
    again.commit(["x"])
    assert read_output(spark, out, "x").count() == 5
    assert [n for n in again.folder.names("") if n.startswith("_manifest")] == [MANIFEST]


def test_half_written_stage_is_replaced(spark):
    out = shared_dir(spark, "commit-test")
    run = StagedRun(spark, out, "a")
    spark.range(7).write.parquet(f"{out}/runs/{run.run}/x")  # files without a marker
    assert "x" not in run.stages()
    assert run.write("x", spark.range(2)).rows == 2 and run.stages()["x"].read(spark).count() == 2


def test_resumed_retail_run(spark):
    """All logged stages from O2 and O3 on; the first five are not written again."""
    got = resumed_run(RetailStudy(spark, SF), spark).collect()
    assert [r.STAGE for r in got if r.RESUMED] == ["cohort", "staff_assignments", "expanded_patients", "expanded_nurses", "discharge_ratio"]
    plain = {r.STAGE: r.ROW_COUNT for r in run_study(RetailStudy(spark, SF), spark)[1].collect()}
    assert {r.STAGE: r.ROW_COUNT for r in got} == plain and len(plain) == 12
