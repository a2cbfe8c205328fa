"""Invariants of the time-block study on the driver's sf0.001 tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardflow.plans.events_study import EventsStudy

SF = "/root/testdata/sf0.001"


def test_latest_tables_cover_the_expansion(spark):
    st = EventsStudy(spark, SF)
    exp = st.expanded_stays()
    blocks = exp.select("SUBJECT_ID", "HADM_ID", "TIME_BLOCK_12HR").distinct().count()
    subjects = exp.select("SUBJECT_ID").distinct().count()
    assert st.latest_lab("VIEW").count() == blocks
    assert st.latest_per_subject("ERROR").count() == subjects
    assert st.observations().count() == blocks
    # every expanded block has exactly its three sub-blocks per stay row
    per = exp.groupBy("SUBJECT_ID", "HADM_ID", "TIME_BLOCK_12HR").count()
    assert per.where(F.col("count") != 3).count() == 0


def test_no_first_slot_discharge_when_staff_present(spark):
    # staff presence fills all three sub-blocks, so slot 1 is the block start,
    # and a discharge is never counted there (it always lies after the start)
    o5 = EventsStudy(spark, SF).discharge_ratio()
    assert o5.where((F.col("NURSES_4HR_1") > 0) & (F.col("DISCHARGE_4HR_1") > 0)).count() == 0


def test_block_counts_match_expansion(spark):
    st = EventsStudy(spark, SF)
    got = {(r["CURR_CAREUNIT"], r["TIME_BLOCK_12HR"]): r["SUBJECT_COUNT"] for r in st.subject_block_counts().collect()}
    want = {(r["CURR_CAREUNIT"], r["TIME_BLOCK_12HR"]): r["count"] for r in
            st.expanded_stays().where(F.col("CURR_CAREUNIT").isNotNull())
            .groupBy("CURR_CAREUNIT", "TIME_BLOCK_12HR").count().collect()}
    assert got == want
