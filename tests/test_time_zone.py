"""Results must not depend on the session time zone (all times are TIMESTAMP_NTZ)."""

from __future__ import annotations

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_results_independent_of_session_time_zone(spark):
    names = ["event_stays", "expand_stays", "event_staff_ratio", "latest_lab_view", "cohort_select"]
    base = {n: _rows(E.queries()[n](spark, SF)) for n in names}
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        for n in names:
            assert _rows(E.queries()[n](spark, SF)) == base[n], n
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_results_independent_of_ansi_mode(spark):
    names = ["event_staff_ratio", "staff_subject_ratio", "chart_hist", "profile_duplicates"]
    base = {n: _rows(E.queries()[n](spark, SF)) for n in names}
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        for n in names:
            assert _rows(E.queries()[n](spark, SF)) == base[n], n
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
