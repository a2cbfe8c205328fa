"""Every registered query against its DuckDB oracle at sf0.001, and the smoke entry."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from tests.compare_oracle import _hash, _norm
from wardflow.sources.schemas import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) & set(E.study_queries())))
def test_query_matches_oracle(spark, con, name):
    s = E.queries()[name](spark, SF).toPandas()
    o = con.execute(E.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(o.columns)
    assert len(s) == len(o)
    assert _hash(_norm(s)) == _hash(_norm(o))


def test_every_query_has_an_oracle():
    assert set(E.study_queries()) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:4] == ["SUBJECT_ID", "HADM_ID", "CURR_CAREUNIT", "TIME_BLOCK_12HR"]
