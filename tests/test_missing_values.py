"""Null starts, NaN values, other grids, empty inputs, ties, duplicate rows."""

from __future__ import annotations

from datetime import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from wardflow.config import JUNE_2000, CohortSpec, GridSpec
from wardflow.functions.match import code_filter
from wardflow.operators import cohort as K, labs as L, profile as P, summaries as S, timeblocks as tb
from wardflow.plans.cohort_run import run_study
from wardflow.plans.events_study import EventsStudy
from wardflow.sources.commit import read_output

STAYS = ("SUBJECT_ID BIGINT, HADM_ID BIGINT, CURR_CAREUNIT STRING, ADMISSION_DATE TIMESTAMP_NTZ, "
         "DISCHARGE_DATE TIMESTAMP_NTZ")
LABS = ("SUBJECT_ID BIGINT, HADM_ID BIGINT, ITEMID BIGINT, CHARTTIME TIMESTAMP_NTZ, VALUENUM DOUBLE, "
        "VALUEUOM STRING, LABEL STRING")


def test_null_start_has_no_block(spark):
    staff = spark.createDataFrame([("CCU", 1, None, dt(2000, 6, 3))],
                                  "CURR_CAREUNIT STRING, CGID BIGINT, STARTTIME TIMESTAMP_NTZ, ENDTIME TIMESTAMP_NTZ")
    assert tb.expand_staff(staff, JUNE_2000).count() == 0
    assert tb.shift_block_coverage(staff, JUNE_2000).count() == 0


def test_nan_value_is_missing(spark):
    stays = spark.createDataFrame([(1, 10, "CCU", dt(2000, 6, 2), dt(2000, 6, 4))], STAYS)
    labs = spark.createDataFrame([(1, 10, 5, dt(2000, 6, 2, 1), 0.5, "ng", "Troponin"),
                                  (1, 10, 5, dt(2000, 6, 2, 2), float("nan"), "ng", "Troponin")], LABS)
    subset = L.subset_labs(stays, labs)
    got = L.latest_lab(stays, subset, JUNE_2000, "Troponin", "T").collect()
    assert [r.T_VAL for r in got] == [0.5] * 4
    assert L.latest_per_subject(stays, subset, JUNE_2000, "Troponin", "T").first().T_VAL == 0.5


def test_each_operator_obeys_its_own_grid(spark):
    stays = spark.createDataFrame([(1, 10, "CCU", dt(2000, 6, 3), dt(2000, 6, 4))], STAYS)
    later = GridSpec(dt(2000, 6, 3), dt(2000, 6, 30, 23, 59))
    annotated = tb.add_block_range(stays, "ADMISSION_DATE", "DISCHARGE_DATE", JUNE_2000)
    blocks = {r.TIME_BLOCK_12HR for r in tb.expand_stays(annotated, later).collect()}
    assert blocks == {dt(2000, 6, 3), dt(2000, 6, 3, 12)}


def test_empty_inputs_count_zero(spark):
    empty = spark.createDataFrame([], STAYS)
    assert K.cohort_subject_count(empty).first().N_SUBJECTS == 0
    row = P.key_uniqueness({"t": empty}, {"t": ["HADM_ID"]}).first()
    assert (row.ROW_COUNT, row.DISTINCT_KEYS, row.DUPLICATED_KEYS, row.NULL_KEY_ROWS) == (0, 0, 0, 0)


def test_last_unit_tie_goes_to_the_later_admit(spark):
    rows = [(1, 10, "A", dt(2000, 6, 2), dt(2000, 6, 5)), (1, 10, "B", dt(2000, 6, 3), dt(2000, 6, 5))]
    for order in (rows, rows[::-1]):
        stays = spark.createDataFrame(order, STAYS).coalesce(1)
        assert S.last_unit_with_labs(stays, JUNE_2000, {}).first().CURR_CAREUNIT == "B"


def test_duplicates_and_hash_collisions(spark, monkeypatch):
    rows = [(1, "a", -0.0), (1, "a", 0.0), (1, "a", float("nan")), (1, "a", float("nan")), (2, None, 1.0), (2, None, 1.0)]
    twice = spark.createDataFrame(rows, "k INT, s STRING, x DOUBLE")
    once = spark.range(50).withColumn("y", F.col("id") % 7)
    empty = once.limit(0)

    def report():
        return {r.TABLE_NAME: (r.ROW_COUNT, r.DUPLICATE_ROWS)
                for r in P.duplicate_report({"twice": twice, "once": once, "empty": empty}).collect()}
    want = {"twice": (6, 3), "once": (50, 0), "empty": (0, 0)}
    assert report() == want
    # every column hashes alike: all rows are candidates and the full rows decide
    monkeypatch.setattr(P, "_normalised_sql", lambda name, t: "1")
    assert report() == want


def test_caseless_prefixes_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([("4280",), ("4299",), ("42x",)], "c STRING").write.parquet(f"{tmp_path}/d")
    d = spark.read.parquet(f"{tmp_path}/d").where(code_filter(F.col("c"), CohortSpec().code_prefixes, CohortSpec().code_equals))
    assert {r.c for r in d.collect()} == {"4280", "4299"}
    assert "StringStartsWith(c,428)" in d._jdf.queryExecution().executedPlan().toString()


def test_shared_inputs_are_owned(spark):
    study = EventsStudy.shared(spark, "/root/testdata/sf0.001")
    assert EventsStudy.shared(spark, "/root/testdata/sf0.001") is study
    n = study.labs.count()
    study.close()
    assert study.folder is None and study.labs.count() == n
    spark.sparkContext._wardflow_studies.clear()


@pytest.fixture(scope="module")
def written(spark):
    out, counts = run_study(EventsStudy(spark, "/root/testdata/sf0.001"), spark)
    return out, {r.STAGE: r.ROW_COUNT for r in counts.collect()}


# the query whose oracle gives the rows of each written stage
STAGE_SQL = {"expanded_patients": "expand_stays", "expanded_nurses": "expand_staff", "discharge_ratio": "event_staff_ratio",
             "patient_ratio": "staff_subject_ratio", "labs_subset": "labs_subset", "lab_results_view": "latest_lab_view",
             "lab_results_error": "latest_lab_error", "latest_view": "latest_per_subject_view",
             "latest_error": "latest_per_subject_error", "observations": "observations"}


@pytest.mark.parametrize("stage", sorted(STAGE_SQL))
def test_every_written_stage_has_the_right_values(spark, written, stage):
    import __spark_entry__ as E
    from tests.compare_oracle import _hash, _norm
    from wardflow.sources.schemas import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    want = con.execute(E.oracle_sql()[STAGE_SQL[stage]]).df()
    got = E._rounded(read_output(spark, written[0], stage)).toPandas()
    assert len(got) == written[1][stage]
    assert _hash(_norm(got)) == _hash(_norm(want[got.columns]))
