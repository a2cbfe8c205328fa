"""The whole cohort run — every stage written once, counted, and committed together.

A run writes aside (``sources.commit``): its inputs (O2, O3) and the stages the reference writes, in
three steps of independent Spark jobs.  Later stages start from the files of earlier ones, so no stage is computed
twice and a lost executor costs only its own tasks.  Row counts are gathered with ``observe`` during each write.
"""

from __future__ import annotations

import copy
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from threading import Event

from pyspark.sql import DataFrame, SparkSession

from wardflow.operators import labs as L, observations as O
from wardflow.plans.events_study import EventsStudy
from wardflow.plans.metrics import metrics_frame
from wardflow.plans.study import Study
from wardflow.session import shared_dir
from wardflow.sources.commit import StagedRun

INPUTS = {"cohort": "stays", "staff_assignments": "staff"}  # stage that the reference logs: the study's table
_TIMELINES = "_timelines"


class CohortRun:
    """The steps of one study's run: functions from the written stages to the next ones."""

    def __init__(self, study: Study, staged: StagedRun, fmt: str = "csv", parallel: int = 4,
                 on_stage: Callable[[str], None] | None = None):
        self.study = copy.copy(study)  # its inputs are replaced by the run's files
        self.staged, self.fmt, self.parallel, self.on_stage = staged, fmt, parallel, on_stage
        self.done = staged.stages()

    def read(self, name: str) -> DataFrame:
        return self.done[name].read(self.staged.spark)

    def _write_all(self, todo: dict[str, Callable[[], DataFrame]], fmt: str) -> None:
        """Write the stages that are missing; up to ``parallel`` independent jobs at once fill the cluster."""
        stopped = Event()  # after a failure no further stage starts

        def one(name: str) -> None:
            if stopped.is_set():
                return
            try:
                self.done[name] = self.staged.write(name, todo[name](), fmt)
                if self.on_stage:
                    self.on_stage(name)
            except BaseException:
                stopped.set()
                raise
        with ThreadPoolExecutor(max_workers=max(1, self.parallel)) as pool:
            futures = [pool.submit(one, n) for n in todo if n not in self.done]
        for f in futures:
            f.result()

    def run(self) -> dict[str, int]:
        """Write every stage; returns the rows of each, in the reference's order."""
        s, tests = self.study, tuple(self.study.tests)
        # a study that keeps written inputs has counted them, too
        inputs = {name: lambda a=attr: getattr(s, a) for name, attr in INPUTS.items() if attr not in s.input_rows}
        self._write_all(inputs, "parquet")
        for name in inputs:
            s.__dict__[INPUTS[name]] = self.read(name)
        first = {"expanded_patients": s.expanded_stays, "expanded_nurses": s.expanded_staff, "discharge_ratio": s.discharge_ratio,
                 "patient_ratio": s.patient_ratio, "labs_subset": s.lab_subset}
        self._write_all(first, self.fmt)
        self._write_all({_TIMELINES: lambda: L.stay_timelines(s.cohort, self.read("labs_subset"), s.grid, tests)}, "parquet")

        def block_values() -> DataFrame:
            return L.block_values(self.read(_TIMELINES), s.grid, tests)

        def lab_result(p: str) -> DataFrame:
            return block_values().select("SUBJECT_ID", "HADM_ID", "TIME_BLOCK_12HR", f"{p}_VAL", f"{p}_UNIT")

        def latest(p: str) -> DataFrame:
            return L.pick_latest_per_subject(block_values(), tests).select("SUBJECT_ID", f"{p}_VAL", f"{p}_UNIT")
        last = {f"lab_results_{p.lower()}": lambda p=p: lab_result(p) for p, _ in tests}
        last |= {f"latest_{p.lower()}": lambda p=p: latest(p) for p, _ in tests}
        last["observations"] = lambda: O.assemble(O.admission_blocks(s.cohort, s.grid), self.read(_TIMELINES),
                                                  self.read("discharge_ratio"), self.read("patient_ratio"), s.grid, tests)
        self._write_all(last, self.fmt)
        counted = {n: s.input_rows[attr] for n, attr in INPUTS.items() if n not in inputs}
        return counted | {n: self.done[n].rows for n in [*inputs, *first, *last]}


def run_study(study: Study, spark: SparkSession, out_dir: str | None = None, fmt: str = "csv", parallel: int = 4,
              on_stage: Callable[[str], None] | None = None):
    """Run every stage of ``study`` and commit them; returns (output folder, (STAGE, ROW_COUNT) DataFrame).

    If a run of the same study, inputs and format into ``out_dir`` stopped, it is
    resumed.  ``on_stage`` is called after each written stage; what it raises stops the run.
    The committed stages are read with ``sources.commit.read_output``.
    """
    out_dir = out_dir or shared_dir(spark, "wardflow-output")
    staged = StagedRun(spark, out_dir, f"{study.fingerprint()} {fmt}")
    counts = CohortRun(study, staged, fmt, parallel, on_stage).run()
    staged.commit([n for n in counts if n not in INPUTS])
    return out_dir, metrics_frame(spark, counts)


def run(spark: SparkSession, sf_dir: str, out_dir: str | None = None, fmt: str = "csv"):
    """The whole run over the driver's events table, from the session's shared inputs."""
    return run_study(EventsStudy.shared(spark, sf_dir), spark, out_dir, fmt)


class _Stopped(Exception):
    pass


def resumed_run(study: Study, spark: SparkSession, stop_after: int = 5) -> DataFrame:
    """A run that stops after ``stop_after`` stages and is started again: STAGE, ROW_COUNT, RESUMED.

    RESUMED marks the stages that the second start found complete and did not write again.
    """
    out_dir, seen = shared_dir(spark, "wardflow-output"), []

    def stop(name: str) -> None:
        seen.append(name)
        if len(seen) == stop_after:
            raise _Stopped(name)
    try:
        run_study(study, spark, out_dir, parallel=1, on_stage=stop)
    except _Stopped:
        pass
    written: list[str] = []
    _, counts = run_study(study, spark, out_dir, on_stage=written.append)
    rows = [(r.STAGE, r.ROW_COUNT, r.STAGE not in written) for r in counts.collect()]  # one row per stage
    return spark.createDataFrame(rows, "STAGE STRING, ROW_COUNT BIGINT, RESUMED BOOLEAN")
