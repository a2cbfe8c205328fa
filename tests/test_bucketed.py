"""Lab joins over bucketed stage tables have no exchange."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from wardflow.operators import labs as L, observations as O
from wardflow.plans.events_study import EventsStudy
from wardflow.session import file_stamp, shared_dir
from wardflow.sources.bucketed import write_bucketed

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def study(spark):
    s = EventsStudy(spark, SF).materialise_inputs()
    yield s
    s.close()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lab_subset_and_latest_labs_have_no_exchange(study, no_broadcast):
    tests = tuple(study.tests)
    timelines = L.stay_timelines(study.cohort, study.lab_subset(), study.grid, tests)
    blocks = O.admission_blocks(study.cohort, study.grid)
    tested = blocks.join(timelines, ["SUBJECT_ID", "HADM_ID"], "left")
    for df in (study.lab_subset(), timelines, study.latest_lab("VIEW"), tested):
        plan = _plan(df)
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        assert "Exchange" not in plan, plan


def test_observations_exchange_only_above_the_lab_joins(study, no_broadcast):
    """The joins by (subject, admission) have no exchange below them; only those with the ratio tables do."""
    lines = _plan(study.observations()).split("\n")
    depth = [len(re.match(r"[\s:+|-]*", x)[0]) for x in lines]
    found = 0
    for i, line in enumerate(lines):
        if "Join" in line and "HADM_ID" in line:
            found += 1
            below = []
            for j in range(i + 1, len(lines)):
                if depth[j] <= depth[i]:
                    break
                below.append(lines[j])
            assert not any("Exchange" in x for x in below)
    assert found >= 2


def test_same_rows_as_without_buckets(spark, study):
    plain = EventsStudy(spark, SF)
    for name in ("lab_subset", "observations"):
        a, b = getattr(study, name)(), getattr(plain, name)()
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())) and a.count()


def test_bucketed_table_is_dropped_with_its_files(spark):
    path = shared_dir(spark, "bucket-test")
    t = write_bucketed(spark.range(100).withColumn("k", F.col("id") % 7), path, ["k"], 4)
    assert t.read().count() == 100 and spark.catalog.tableExists(t.name)
    assert "Exchange" not in _plan(t.read().groupBy("k").count())
    t.drop()
    assert not spark.catalog.tableExists(t.name)
    with pytest.raises(Exception):
        spark.read.parquet(path)


def test_file_stamp_sees_files_not_folders(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    spark.range(5).withColumn("v", F.col("id")).coalesce(1).write.partitionBy("id").parquet(path)
    one = file_stamp(spark, path)
    assert file_stamp(spark, path) == one
    (part,) = (tmp_path / "t.parquet" / "id=3").glob("*.parquet")
    part.write_bytes(part.read_bytes() + b"x")
    assert file_stamp(spark, path) != one


def test_shared_inputs_follow_the_files(spark, tmp_path):
    import shutil
    for n in ("events", "customer"):
        shutil.copy(f"{SF}/{n}.parquet", f"{tmp_path}/{n}.parquet")
    first = EventsStudy.shared(spark, str(tmp_path))
    assert EventsStudy.shared(spark, str(tmp_path)) is first
    fewer = spark.read.parquet(f"{SF}/events.parquet").where("event_id % 2 = 0").coalesce(1)
    fewer.write.parquet(f"{tmp_path}/new")
    shutil.copy(next((tmp_path / "new").glob("*.parquet")), f"{tmp_path}/events.parquet")
    second = EventsStudy.shared(spark, str(tmp_path))
    assert second is not first and first.folder is None
    second.close()
    spark.sparkContext._wardflow_studies.clear()
