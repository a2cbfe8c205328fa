"""Clinical times kept as text (X1, N11): parsed at the source, unparsable ones are NULL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tests.clinical_fixture import tables
from wardflow.plans.clinical_study import ClinicalStudy
from wardflow.sources.schemas import CLINICAL_DDL
from wardflow.sources.tables import typed_times

TIMES = {"TRANSFERS": ["INTIME", "OUTTIME"], "TREATMENT_TEAM": ["STARTTIME", "ENDTIME"], "LABS": ["CHARTTIME"]}


def test_text_times_give_the_same_study(spark):
    typed = tables(spark)
    text = {n: t.withColumns({c: F.col(c).cast("string") for c in TIMES.get(n, [])}) for n, t in typed.items()}
    want, got = ClinicalStudy(typed), ClinicalStudy(text)
    for stage in ("stays", "staff"):
        a, b = getattr(want, stage), getattr(got, stage)
        assert a.schema == b.schema and sorted(map(str, a.collect())) == sorted(map(str, b.collect())) and a.count()
    assert dict(got.tables["LABS"].dtypes)["CHARTTIME"] == "timestamp_ntz"


def test_unparsable_time_is_null(spark):
    rows = [(1, "2000-06-01 10:00:00"), (2, "not a time"), (3, "2000-13-45 10:00:00"), (4, ""), (5, None)]
    df = spark.createDataFrame([(h, 1, t, t) for h, t in rows], "HADM_ID BIGINT, CGID BIGINT, STARTTIME STRING, ENDTIME STRING")
    got = typed_times(df, CLINICAL_DDL["TREATMENT_TEAM"])
    assert [t for _, t in got.dtypes] == ["bigint", "bigint", "timestamp_ntz", "timestamp_ntz"]
    assert {r.HADM_ID: str(r.STARTTIME) for r in got.collect()} == {
        1: "2000-06-01 10:00:00", 2: "None", 3: "None", 4: "None", 5: "None"}


def test_typed_tables_are_left_alone(spark):
    labs = tables(spark)["LABS"]
    assert typed_times(labs, CLINICAL_DDL["LABS"]) is labs
