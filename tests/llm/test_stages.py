"""Pipeline stages on empty tables, null and odd texts, and columns that clash with names used inside."""

from __future__ import annotations

import pytest

import corpus_pipeline

DDL = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
CLASH = DDL + ", row STRING, doc BIGINT, th INT, node BIGINT, key STRING, label STRING, shard INT, kept BOOLEAN, spans STRING, h BIGINT"
PROSE = ("The river ran past the old mill and under a stone bridge where children used to fish on warm evenings. "
         "Nobody could say who had built it, but the oldest of the letters in the town hall spoke of a flood. "
         "After that year the market moved up the hill, and the lower streets were given to gardens and orchards. ")
ROWS = [(1, PROSE), (2, None), (3, ""), (4, " \n\t"), (5, PROSE + "Later came the railway and with it strangers."), (None, PROSE * 2),
        (6, "x" * 30_000), (6, PROSE.upper()), (7, PROSE), (7, PROSE)]


@pytest.mark.parametrize("k", range(5), ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stage_edges(spark, k):
    stage = corpus_pipeline.STAGES[k][1]
    rows = [(d, t, "en", "s", len(t or ""), "r", 1, 2, 3, "k", "l", 4, True, "p", 5) for d, t in ROWS]
    for ddl, data in ((DDL, [r[:5] for r in rows]), (CLASH, rows)):
        assert stage(spark, spark.createDataFrame([], ddl), "").count() == 0
        frame = spark.createDataFrame(data, ddl)
        got = stage(spark, frame, "").collect()
        if k < 4:
            assert got and set(map(tuple, got)) <= {tuple(r) for r in data} | {tuple(r) for r in got if r.text is not None and k == 3}
            assert got[0].__fields__ == frame.columns
        else:  # every row is packed, nulls and empty texts as their end mark
            assert len({(r.doc_id, r.ids_crc32) for r in got}) >= 8 and sum(r.length for r in got) > 1000


def test_stages_keep_one_row_of_each_group(spark):
    """Exact copies leave one row, whatever their ids; different texts under one id are judged apart."""
    frame = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in ROWS], DDL)
    exact = corpus_pipeline.exact_dedup(spark, frame, "").collect()
    texts = ["".join((r.text or "").split()) for r in exact]
    assert len(texts) == len(set(texts)) == len({"".join((t or "").split()) for _, t in ROWS})
