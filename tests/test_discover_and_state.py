"""Keys and references without declarations; the mergeable profile; the catalog."""

from __future__ import annotations

import os
from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardflow.operators.discover import Cells, discover_keys, discover_references
from wardflow.operators.profile import duplicate_report, profile_nulls
from wardflow.operators.profile_state import ProfileState, list_files
from wardflow.session import shared_dir


@pytest.fixture(scope="module")
def tables(spark):
    person = spark.createDataFrame([(i, f"n{i % 4}", dt(2000, 1, 1 + i % 3), float(i)) for i in range(12)],
                                   "p_id BIGINT, p_name STRING, p_born TIMESTAMP_NTZ, p_x DOUBLE")
    visit = spark.createDataFrame([(i % 6, i // 6, i % 2, None if i == 3 else i * 1.0, "n1") for i in range(18)],
                                  "v_id INT, v_no INT, v_flag INT, v_x DOUBLE, v_name STRING")
    odd = spark.createDataFrame([(1, float("nan"), -0.0), (2, 1.0, 0.0)], "o_id BIGINT, o_nan DOUBLE, o_zero DOUBLE")
    twice = spark.createDataFrame([(1, 1), (1, 1)], "t_a INT, t_b INT")
    return {"person": person, "visit": visit, "odd": odd, "twice": twice, "empty": person.limit(0)}


def test_discovered_keys(tables):
    got = {(r.TABLE_NAME, r.KEY_COLUMNS) for r in discover_keys(tables).collect()}
    # visit: no column is unique; v_x has a missing value; (v_no, v_flag) repeats
    assert got == {("person", "p_id"), ("person", "p_x"), ("visit", "v_id,v_no"), ("odd", "o_id")}


def test_only_near_unique_columns_and_unrefuted_pairs_are_counted_whole(spark, monkeypatch):
    import wardflow.operators.discover as D
    # a,b names every row; a,c repeats often; b,d repeats in one pair of rows only; low has two values
    rows = [(i // 4, i % 4 + 4 * (i % 3), i % 2, i + (i == 7) * 12, i % 2) for i in range(12_000)]
    rows[19] = (rows[19][0], rows[7][1], rows[19][2], rows[7][3], rows[19][4])
    rows[0] = (rows[0][0], rows[0][1], 0, rows[1][3], 0)  # d alone repeats too
    t = spark.createDataFrame(rows, "a BIGINT, b INT, c INT, d BIGINT, low INT")
    cells, whole = [], []
    counted, made = D._counted_pairs, D.Cells
    monkeypatch.setattr(D, "SHARES", (64, 8))
    monkeypatch.setattr(D, "Cells", lambda tables: cells.append({n: df.columns for n, df in tables.items()}) or made(tables))
    monkeypatch.setattr(D, "_counted_pairs", lambda n, df, pairs, r: whole.extend(pairs) or counted(n, df, pairs, r))
    got = {r.KEY_COLUMNS for r in discover_keys({"t": t}).collect()}
    brute = {f"{x},{y}" for i, x in enumerate("abcd") for y in "abcd"[i + 1:] if len({(r["abcd".index(x)], r["abcd".index(y)]) for r in rows}) == len(rows)}
    assert got - {"a,low", "b,low", "c,low", "d,low"} == brute and "a,b" in got and "b,d" not in got
    assert cells == [{"t": ["d"]}]
    assert ("a", "b") in whole and ("a", "c") not in whole and ("a", "low") not in whole


def test_no_key_and_no_rows(spark):
    t = spark.createDataFrame([(1, 1), (1, 1)], "a INT, b INT")
    for tables in ({"t": t}, {"t": t.limit(0)}, {"t": t, "none": spark.createDataFrame([(None,)], "z INT")}):
        assert discover_keys(tables).collect() == []
    assert [tuple(r) for r in discover_keys({"one": t.limit(1)}).collect()] in (
        [("one", "a", 1), ("one", "b", 1)], [("one", "b", 1), ("one", "a", 1)])


def test_column_profile(tables):
    got = {(r.TABLE_NAME, r.COLUMN_NAME): (r.ROW_COUNT, r.NULL_COUNT, r.DISTINCT_VALUES, r.IS_KEY) for r in Cells(tables).profile().collect()}
    assert got["visit", "v_x"] == (18, 1, 17, False) and got["odd", "o_nan"] == (2, 1, 1, False)
    assert got["odd", "o_zero"] == (2, 0, 1, False)  # -0.0 equals 0.0
    assert got["empty", "p_id"] == (0, 0, 0, False) and len(got) == 4 + 5 + 3 + 2 + 4


def test_discovered_references(tables):
    got = {(r.CHILD_COLUMN, r.PARENT_COLUMN): (r.N_VALUES, r.PARENT_VALUES, r.SAME_NAME) for r in discover_references(tables).collect()
           if r.PARENT_TABLE == "person"}
    assert got["v_id", "p_id"] == (6, 12, True)          # INT in BIGINT
    assert got["v_flag", "p_id"] == (2, 12, False)
    assert got["o_zero", "p_x"] == (1, 12, False)        # -0.0 and 0.0 are one value
    assert got["o_id", "p_id"] == (2, 12, True)
    assert ("v_x", "p_x") not in got                     # 12.0 and more have no parent
    assert ("v_name", "p_name") not in got               # p_name is no key
    assert ("p_id", "p_x") not in got                    # another class of type


def test_text_that_looks_like_a_number_is_another_class(spark):
    a = spark.createDataFrame([(1,), (2,)], "a_id BIGINT")
    b = spark.createDataFrame([("1",), ("2",)], "b_id STRING")
    assert discover_references({"a": a, "b": b}).count() == 0


SCHEMA = {"t": "k BIGINT, s STRING, x DOUBLE", "u": "k BIGINT"}


def _write(spark, folder, name, rows, ddl):
    spark.createDataFrame(rows, ddl).coalesce(1).write.mode("overwrite").parquet(f"{folder}/tmp-{name}")
    (part,) = [f for f in os.listdir(f"{folder}/tmp-{name}") if f.endswith(".parquet")]
    return open(f"{folder}/tmp-{name}/{part}", "rb").read()


def _check(spark, state, paths):
    """The state's reports equal the full profile of the files."""
    listing = list_files(spark, paths)
    full = {n: spark.read.schema(SCHEMA[n]).parquet(p) for n, p in paths.items()}
    assert sorted(state.nulls(listing).collect()) == sorted(profile_nulls(full).collect())
    assert sorted(state.duplicates(listing).collect()) == sorted(duplicate_report(full).collect())


def test_only_new_and_changed_files_are_read(spark, tmp_path):
    nan = float("nan")
    files = {"t/a": [(1, None, nan), (1, None, nan), (2, "x", 0.0)], "t/b": [(2, "x", -0.0), (None, "y", 1.0)],
             "t/c d": [(7, "z", None)] * 3, "u/a": [(5,), (5,), (None,)]}
    for t in "tu":
        (tmp_path / t).mkdir()
    raw = {n: _write(spark, tmp_path, n.replace("/", "-").replace(" ", "-"), rows, SCHEMA[n[0]]) for n, rows in files.items()}
    paths = {t: f"{tmp_path}/{t}" for t in "tu"}

    def put(name):
        (tmp_path / f"{name}.parquet").write_bytes(raw[name])
    put("t/a"), put("u/a")
    state = ProfileState(spark, shared_dir(spark, "state-test"), SCHEMA)
    assert [os.path.basename(p) for p in state.update(list_files(spark, paths))] == ["a.parquet", "a.parquet"]
    _check(spark, state, paths)
    # the old files become unreadable, their size and time stay: only the new ones are read
    for name in ("t/a", "u/a"):
        f = tmp_path / f"{name}.parquet"
        stat = f.stat()
        f.write_bytes(b"x" * stat.st_size)
        os.utime(f, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    put("t/b"), put("t/c d")
    assert [os.path.basename(p) for p in state.update(list_files(spark, paths))] == ["b.parquet", "c d.parquet"]
    assert state.update(list_files(spark, paths)) == []
    listing = list_files(spark, paths)
    for name in ("t/a", "u/a"):
        stat = (tmp_path / f"{name}.parquet").stat()
        put(name)
        os.utime(tmp_path / f"{name}.parquet", ns=(stat.st_atime_ns, stat.st_mtime_ns))
    assert {r.TABLE_NAME: (r.ROW_COUNT, r.DUPLICATE_ROWS) for r in state.duplicates(listing).collect()} == {"t": (8, 4), "u": (3, 1)}
    _check(spark, state, paths)
    # a changed file replaces its old version, a deleted one no longer counts
    raw["t/b"] = _write(spark, tmp_path, "new", [(9, "q", None)], SCHEMA["t"])
    put("t/b")
    (tmp_path / "t/c d.parquet").unlink()
    assert [os.path.basename(p) for p in state.update(list_files(spark, paths))] == ["b.parquet"]
    _check(spark, state, paths)


def test_stopped_batch_counts_for_nothing(spark, tmp_path):
    spark.range(5).withColumnRenamed("id", "k").write.parquet(f"{tmp_path}/u")
    paths = {"u": f"{tmp_path}/u"}
    state = ProfileState(spark, shared_dir(spark, "state-test"), {"u": SCHEMA["u"]})
    listing = list_files(spark, paths)
    rows = state._rows("u", [r.path for r in listing.collect()])
    rows.join(listing.select("uri", "file"), "uri").selectExpr("TABLE_NAME", "file", "h1", "h2", "n", "missing", "'lost' AS batch").write.parquet(
        f"{state.folder}/rows")  # the list of files was never written
    assert state.duplicates(listing).first().ROW_COUNT == 0
    state.update(listing)
    assert tuple(state.duplicates(listing).first()) == ("u", 5, 0)


def test_many_columns(spark, tmp_path):
    ddl = ", ".join(f"c{i} INT" for i in range(130))
    df = spark.createDataFrame([tuple(None if i % 61 == 0 else i for i in range(130))] * 2, ddl)
    df.write.parquet(f"{tmp_path}/w")
    state = ProfileState(spark, shared_dir(spark, "state-test"), {"w": ddl})
    listing = list_files(spark, {"w": f"{tmp_path}/w"})
    state.update(listing)
    assert {r.COLUMN_NAME: r.NULL_COUNT for r in state.nulls(listing).collect()} == {"c0": 2, "c61": 2, "c122": 2}
    assert tuple(state.duplicates(listing).first()) == ("w", 2, 1)


def test_catalog_views_do_not_stay(spark):
    from wardflow.plans.profiling import Profiling
    from wardflow.sources.tables import Tables, list_tables
    before = set(list_tables(spark))
    assert Profiling(spark, "/root/testdata/sf0.001").catalog_report().count() == 14
    assert set(list_tables(spark)) == before
    t = Tables(spark, "/root/testdata/sf0.001", ("nation", "region"))
    t.register_views("s2_")
    assert list_tables(spark, "s2_") == ["s2_nation", "s2_region"] and spark.table("s2_nation").count() == t["nation"].count()
    t.drop_views("s2_")
