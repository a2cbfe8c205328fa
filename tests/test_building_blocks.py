"""Brute-force checks of the custom building blocks on small random inputs."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from wardflow.operators.timeblocks import coverage_counts


def test_coverage_counts_match_brute_force(spark):
    rnd = random.Random(5)
    rows = []
    for _ in range(300):
        f = rnd.randint(0, 50)
        rows.append((rnd.choice("ab"), f, f + rnd.randint(0, 12)))
    df = spark.createDataFrame(rows, "u STRING, f BIGINT, l BIGINT")
    got = {(r["u"], r["slot"]): r["n"] for r in coverage_counts(df, "u", "f", "l").collect()}
    want = {}
    for u, f, l in rows:
        for s in range(f, l + 1):
            want[(u, s)] = want.get((u, s), 0) + 1
    assert got == want


def test_events_stays_discharge_is_next_purchase(spark):
    from wardflow.sources import events_view as ev
    from wardflow.sources.tables import Tables
    t = Tables(spark, "/root/testdata/sf0.001")
    stays = {r["HADM_ID"]: r["DISCHARGE_DATE"] for r in ev.stays(t).collect()}
    e = t["events"].select("user_id", "event_id", "ts", "event_type").collect()
    buys = {}
    for r in e:
        if r["event_type"] == "purchase":
            buys.setdefault(r["user_id"], []).append(r["ts"])
    for r in e:
        if r["event_type"] == "signup":
            later = [p for p in buys.get(r["user_id"], []) if p > r["ts"]]
            assert stays[r["event_id"]] == (min(later) if later else None)


def test_episode_scan_matches_brute_force(spark):
    from wardflow.functions.scan import episode_scan
    rnd = random.Random(11)
    t0 = datetime(2024, 1, 1)
    rows = []
    for i in range(800):
        key = 0 if rnd.random() < 0.35 else rnd.randint(1, 6)           # one hot key
        ts = t0 + timedelta(minutes=rnd.randint(0, 60 * 30))            # ties, many buckets
        rows.append((key, i, ts, rnd.choice([0, 1, 1, 2, 2])))         # 0 end, 1 start, 2 other
    df = spark.createDataFrame(rows, "k BIGINT, id BIGINT, ts TIMESTAMP_NTZ, kind INT")
    got = episode_scan(df, "k", "ts", ["kind", "id"], "kind = 0", "kind = 1", ranges=16)
    got = {r["id"]: (r["S"], r["S_open"], r["NEXT_END"]) for r in got.collect()}
    for k in {r[0] for r in rows}:
        seq = sorted((r for r in rows if r[0] == k), key=lambda r: (r[2], r[3], r[1]))
        s = s_open = 0
        for i, r in enumerate(seq):
            s += r[3] == 1
            if r[3] == 0:
                s_open = s
            nxt = next((q[2] for q in seq[i + 1:] if q[3] == 0), None)
            assert got[r[1]] == (s, s_open, nxt), r


def test_episode_scan_splits_a_users_hour(spark, monkeypatch):
    """One user with a third of all rows within one hour: rows per range stay bounded."""
    from wardflow.functions import scan
    t0 = datetime(2024, 1, 1)
    rows = [(0, i, t0 + timedelta(seconds=i % 3600), i % 3) for i in range(2000)]
    rows += [(1 + i % 40, 2000 + i, t0 + timedelta(minutes=i), i % 3) for i in range(4000)]
    df = spark.createDataFrame(rows, "k BIGINT, id BIGINT, ts TIMESTAMP_NTZ, kind INT")
    written = []
    cut = scan.cut_lineage
    monkeypatch.setattr(scan, "cut_lineage", lambda d: written.append(cut(d)) or written[0])
    got = {r["id"]: (r["S"], r["S_open"]) for r in
           scan.episode_scan(df, "k", "ts", ["kind", "id"], "kind = 0", "kind = 1", ranges=12).collect()}
    assert max(r["count"] for r in written[0].groupBy("_bucket").count().collect()) <= 2 * len(rows) / 12
    s = s_open = 0
    for k, i, ts, kind in sorted((r for r in rows if r[0] == 0), key=lambda r: (r[2], r[3], r[1])):
        s += kind == 1
        s_open = s if kind == 0 else s_open
        assert got[i] == (s, s_open)


def test_exact_quantiles_match_percentile(spark):
    from wardflow.operators.chartdata import exact_quantiles
    rnd = random.Random(2)
    rows = [("hot" if rnd.random() < 0.5 else rnd.choice("abc"), float(rnd.choice([rnd.randint(0, 40), 7])))
            for _ in range(2000)]
    df = spark.createDataFrame(rows, "g STRING, y DOUBLE")
    probs = [0.25, 0.5, 0.75, 0.9]
    got = {r["g"]: [r[f"Q{i}"] for i in range(4)] for r in exact_quantiles(df, ["g"], "y", probs, buckets=8).collect()}
    want = {r["g"]: r["p"] for r in df.groupBy("g").agg(F.percentile("y", probs).alias("p")).collect()}
    assert got.keys() == want.keys()
    for g in got:
        assert [round(v, 9) for v in got[g]] == [round(v, 9) for v in want[g]], g
    single = exact_quantiles(df, [], "y", probs, buckets=16).collect()[0]
    allp = df.agg(F.percentile("y", probs).alias("p")).collect()[0]["p"]
    assert [round(single[f"Q{i}"], 9) for i in range(4)] == [round(v, 9) for v in allp]


def test_duplicate_report_exact(spark):
    from wardflow.operators.profile import duplicate_report
    a = spark.createDataFrame([(1, "x", 0.0, [1.0]), (1, "x", -0.0, [1.0]), (1, "x", float("nan"), None),
                               (1, "x", float("nan"), None), (2, None, 1.5, [2.0]), (2, None, 1.5, [2.0]),
                               (2, None, 1.5, [2.0]), (3, "y", 1.0, [float("nan")])],
                              "k INT, s STRING, v DOUBLE, arr ARRAY<FLOAT>")
    b = spark.createDataFrame([(i,) for i in range(50)], "i BIGINT")
    got = {r["TABLE_NAME"]: (r["ROW_COUNT"], r["DUPLICATE_ROWS"]) for r in duplicate_report({"a": a, "b": b}).collect()}
    assert got["b"] == (50, 0)
    assert got["a"] == (8, 8 - a.distinct().count())


def test_csv_stage_keeps_microseconds(spark):
    from wardflow.session import shared_dir
    from wardflow.sources.sinks import read_stage, write_stage
    df = spark.createDataFrame([(1, datetime(2024, 1, 1, 3, 4, 5, 123456), None)],
                               "k BIGINT, t TIMESTAMP_NTZ, v DOUBLE")
    path = shared_dir(spark, "csv-test")
    write_stage(df, path, "csv")
    assert read_stage(spark, path, df.schema, "csv").collect() == df.collect()


def test_frequent_test_is_dealt_to_many_tasks(spark):
    """The dictionary join spreads the rows of one item; rows, nulls and several names of an item stay as a plain join has them."""
    from wardflow.operators.cohort import tested_admissions
    from wardflow.operators.labs import label_labs, subset_labs
    labs = spark.createDataFrame([(i % 50, i, 7 if i % 100 else (None if i % 200 else 8), datetime(2000, 6, 2, i % 24), float(i), "u") for i in range(4000)],
                                 "SUBJECT_ID BIGINT, HADM_ID BIGINT, ITEMID BIGINT, CHARTTIME TIMESTAMP_NTZ, VALUENUM DOUBLE, VALUEUOM STRING")
    names = spark.createDataFrame([(7, "Troponin I"), (7, "NTproBNP"), (9, "BNP"), (None, "BNP"), (8, "Sodium")], "ITEMID BIGINT, LABEL STRING")
    plain = labs.join(names, "ITEMID")
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = label_labs(labs, names)
        sizes = [len(p) for p in got.rdd.glom().collect()]
        assert max(sizes) < sum(sizes) / 2, sizes
        assert got.columns == plain.columns and sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
        cohort = spark.createDataFrame([(i % 50, i, c, datetime(2000, 6, 2), datetime(2000, 6, 2, 12)) for i in range(0, 4000, 3) for c in ("a", "b")],
                                       "SUBJECT_ID BIGINT, HADM_ID BIGINT, ICD9_CODE STRING, ADMISSION_DATE TIMESTAMP_NTZ, DISCHARGE_DATE TIMESTAMP_NTZ")
        subset = subset_labs(cohort, labs, dictionary=names)
        same = subset_labs(cohort, plain)  # rows that carry their label
        assert subset.columns == same.columns and subset.count() == sum(4 for i in range(0, 4000, 3) if i % 100 and i % 24 < 12)
        assert sorted(map(str, subset.collect())) == sorted(map(str, same.collect()))
        assert tested_admissions(labs, "bnp", names).count() == sum(1 for i in range(4000) if i % 100)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
