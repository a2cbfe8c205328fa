"""The study on the driver's events table."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from wardflow.config import EVENTS_GRID, GridSpec
from wardflow.operators.profile import profile_nulls
from wardflow.plans.study import Study
from wardflow import config as C
from wardflow.session import delete_path, file_stamp, owned_dir
from wardflow.sources import events_view as ev
from wardflow.sources.bucketed import BucketedTable, write_bucketed
from wardflow.sources.sinks import materialise
from wardflow.sources.tables import Tables

# Fixed values of the events mapping: lab labels standing for the two tests.
TESTS = (("VIEW", "view"), ("ERROR", "error"))
COUNT_NAMES = {"VIEW": "View_Count", "ERROR": "Error_Count"}


class EventsStudy(Study):
    """Stages over one scale-factor folder, as lazy plans.

    ``EventsStudy.shared`` gives the study whose inputs (ordered events, stays,
    shifts, attributed labs) are written once per session and folder; it owns
    those tables, and ``close`` deletes them.  Stays and labs are bucketed by
    (subject, admission), so the stages that join or group them by these keys
    read them without an exchange.
    """

    tests = TESTS
    count_names = COUNT_NAMES

    def __init__(self, spark: SparkSession, sf_dir: str, grid: GridSpec = EVENTS_GRID):
        self.t = Tables(spark, sf_dir)
        self.grid = grid
        self.folder: str | None = None
        self.tables: list[BucketedTable] = []

    @cached_property
    def ordered(self) -> DataFrame:
        return ev.ordered_events(self.t)

    @cached_property
    def stays(self) -> DataFrame:
        return ev.stays(self.t, self.ordered)

    @cached_property
    def staff(self) -> DataFrame:
        return ev.staff(self.t)

    @cached_property
    def labs(self) -> DataFrame:
        return ev.labs(self.t, self.ordered)

    def fingerprint(self) -> str:
        return f"{type(self).__name__} {self._stamp(self.t.spark, self.t.sf_dir)} {self.grid} {self.tests}"

    @staticmethod
    def _stamp(spark: SparkSession, sf_dir: str) -> tuple[str, ...]:
        return tuple(file_stamp(spark, f"{sf_dir.rstrip('/')}/{n}.parquet") for n in ("events", "customer"))

    @classmethod
    def shared(cls, spark: SparkSession, sf_dir: str) -> EventsStudy:
        """The session's study of one folder with its inputs written; written anew when the tables have changed."""
        held = spark.sparkContext.__dict__.setdefault("_wardflow_studies", {})
        stamp = cls._stamp(spark, sf_dir)
        old = held.get((cls, sf_dir))
        if old is None or old[0] != stamp:
            if old is not None:
                old[1].close()
            held[cls, sf_dir] = stamp, cls(spark, sf_dir).materialise_inputs()
        return held[cls, sf_dir][1]

    def materialise_inputs(self) -> EventsStudy:
        """Write the inputs once to a folder of this study and go on from the files."""
        self.folder = owned_dir(self.t.spark, "wardflow-inputs")
        counted = {name: Observation() for name in ("stays", "staff")}

        def seen(name: str) -> DataFrame:
            return getattr(self, name).observe(counted[name], F.count(F.lit(1)).alias("rows"))
        self.__dict__["ordered"] = materialise(self.t.spark, self.ordered, f"{self.folder}/ordered")
        self.__dict__["staff"] = materialise(self.t.spark, seen("staff"), f"{self.folder}/staff")
        for name, rows in (("stays", seen("stays")), ("labs", self.labs)):
            table = write_bucketed(rows, f"{self.folder}/{name}", [C.SUBJECT_ID, C.HADM_ID])
            self.tables.append(table)
            self.__dict__[name] = table.read()
        self.input_rows = {name: int(o.get["rows"]) for name, o in counted.items()}
        return self

    def close(self) -> None:
        """Delete the written inputs; the study computes them again when asked."""
        if self.folder:
            for table in self.tables:
                table.drop()
            self.tables, self.input_rows = [], {}
            delete_path(self.t.spark, self.folder)
            self.folder = None
            for name in ("ordered", "stays", "staff", "labs"):
                self.__dict__.pop(name, None)


class GappyEventsStudy(EventsStudy):
    """The events study with values missing: what null and NaN inputs must lead to.

    Every seventh user's stays have no admit time, every fifth shift no start,
    every eleventh stay no unit, and every third test value is NaN.
    """

    @cached_property
    def stays(self) -> DataFrame:
        return ev.stays(self.t, self.ordered).withColumns({
            "ADMISSION_DATE": F.expr("if(SUBJECT_ID % 7 = 0, null, ADMISSION_DATE)"),
            "CURR_CAREUNIT": F.expr("if(HADM_ID % 11 = 0, null, CURR_CAREUNIT)")})

    @cached_property
    def staff(self) -> DataFrame:
        return ev.staff(self.t).withColumn("STARTTIME", F.expr("if(CGID % 5 = 0, null, STARTTIME)"))

    @cached_property
    def labs(self) -> DataFrame:
        return ev.labs(self.t, self.ordered).withColumn("VALUENUM", F.expr("if(ITEMID % 3 = 0, double('NaN'), VALUENUM)"))

    def null_report(self) -> DataFrame:
        """O1/P1 over the study's inputs."""
        return profile_nulls({"stays": self.stays, "staff": self.staff.drop("HADM_ID"), "labs": self.labs})
