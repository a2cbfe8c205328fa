"""Registered queries at sf0.001 against DuckDB or brute force."""

from __future__ import annotations

import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest

from tests.compare_oracle import _hash, _norm
from tests.llm import brute
from wardflow.llm.queries import QUERIES, SQL
from wardflow.sources.schemas import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def docs(con):
    return con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, con, name):
    got, want = QUERIES[name](spark, SF).toPandas(), con.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _hash(_norm(got)) == _hash(_norm(want))


@pytest.fixture(scope="module")
def ids(docs):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return {d: tok.encode(t or "", add_special_tokens=False).ids for d, t in docs}


def test_op1(spark, docs, ids):
    got = QUERIES["op1_grammar_ids"](spark, SF).toPandas().set_index("doc_id")
    start = 0
    for d, _ in docs:
        want = np.array(ids[d] + [2], "<u4")
        assert tuple(got.loc[d][["start", "n_tokens", "ids_crc32"]]) == (start, len(want), zlib.crc32(want.tobytes()))
        start += len(want)
    assert len(got) == len(docs)


def test_op4(spark, docs, ids):
    got = QUERIES["op4_pack_documents"](spark, SF).toPandas()
    for d, rows in got.groupby("doc_id"):
        want, at = np.array(ids[d] + [0], "<u4"), 0
        for r in rows.sort_values("piece").itertuples():
            assert r.start == at and r.ids_crc32 == zlib.crc32(want[at:at + r.length].tobytes())
            assert r.piece == 0 or r.length == 2048
            at += r.length
        assert at == len(want) and (len(rows) == 1 or len(want) > 2048)
    for _, rows in got.groupby("sequence_id"):
        rows = rows.sort_values("offset")
        assert list(rows.offset) == [0, *np.cumsum(rows.length)[:-1]] and rows.length.sum() <= 2048
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 2048) + 2
    assert got.doc_id.nunique() == len(docs)


def test_op5(spark, docs):
    got = QUERIES["op5_substring_dedup"](spark, SF).toPandas()
    want = brute.substring(docs, 20)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got.itertuples()} == {
        d: x[:3] for d, x in want.items()}


def test_op6(spark, docs):
    got = QUERIES["op6_near_dedup"](spark, SF).toPandas()
    want = brute.near(docs, 2, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.itertuples()} == want
    assert (got.kept == (got.doc_id == got.component_id)).all()


def test_op7(spark, docs, con):
    got = QUERIES["op7_compression_rules"](spark, SF).toPandas().set_index("doc_id")
    for d, t in docs:
        w = brute.words(t)
        lines = [x for x in (t or "").split("\n") if brute.words(x)]
        n, rep = len(w), brute.repeats(t)
        assert tuple(got.loc[d][["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]]) == (
            n, sum(len(x.decode()) for x in w), sum((t or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), rep)
        assert got.loc[d].base_failed == (n < 10 or 100 * rep > 20 * n)
    good = con.execute("SELECT doc_id FROM labels WHERE quality = 1").df().doc_id
    good = got.loc[good]
    assert good[~good.base_failed].kept.mean() > 0.98
    assert not got[got.base_failed].kept.any()


def test_op2(spark, con):
    got = QUERIES["op2_importance_resampling"](spark, SF).toPandas()
    assert got.kept.sum() == round(0.8 * len(got))
    assert got[got.kept].key.min() >= got[~got.kept].key.max()
    with_labels = got.merge(con.execute("SELECT * FROM labels").df(), on="doc_id").sort_values("log_weight")
    good = with_labels.quality.to_numpy()
    auc = ((1 - good).cumsum() * good).sum() / (good.sum() * (1 - good).sum())
    assert auc > 0.95


def test_op2_brute_force(spark, con, docs):
    """Buckets, models, weights, keys and the cut, computed again from their definitions."""
    import math
    import re

    import xxhash
    mask, n_buckets = (1 << 64) - 1, 1 << 16
    hashed = {}

    def buckets(text):
        one = [hashed.setdefault(w, xxhash.xxh3_64_intdigest(w)) for w in re.findall(r"\w+|[^\w\s]+", (text or "").lower())]
        two = [(a * 0x9E3779B97F4A7C15 + b) & mask for a, b in zip(one, one[1:])]
        two = [((x ^ (x >> 29)) * 0xBF58476D1CE4E5B9) & mask for x in two]
        return [(x >> 20) % n_buckets for x in one + two]
    grams = {d: buckets(t) for d, t in docs}
    good = {r[0] for r in con.execute("SELECT doc_id FROM labels WHERE quality = 1").fetchall()}
    raw, target = [1.0] * n_buckets, [1.0] * n_buckets
    for d, bs in grams.items():
        for b in bs:
            raw[b] += 1
            target[b] += d in good
    shift = math.log(sum(raw) / sum(target))
    weight = {d: sum(math.log(target[b] / raw[b]) + shift for b in bs) for d, bs in grams.items()}
    got = QUERIES["op2_importance_resampling"](spark, SF).toPandas().set_index("doc_id")
    # the noise is a hash of (doc_id, seed): taken from the engine, all else is recomputed
    u = {r.doc_id: r.u for r in spark.sql(f"SELECT doc_id, (pmod(xxhash64(doc_id, 7), {1 << 52}L) + 0.5D) / {float(1 << 52)}D AS u "
                                          f"FROM parquet.`{SF}/documents.parquet`").collect()}
    key = {d: w - math.log(-math.log(u[d])) for d, w in weight.items()}
    order = sorted(key, key=lambda d: (-key[d], d))
    kept = set(order[:round(0.8 * len(order))])
    assert len(got) == len(docs)
    for d, bs in grams.items():
        assert got.loc[d].n_ngrams == len(bs)
        assert got.loc[d].log_weight == pytest.approx(weight[d], rel=1e-9, abs=1e-7)
        assert got.loc[d].key == pytest.approx(key[d], rel=1e-9, abs=1e-7) and bool(got.loc[d].kept) == (d in kept)


def test_op9(spark, docs):
    import base64

    import tiktoken
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = QUERIES["op9_byte_bpe"](spark, SF).toPandas().set_index("doc_id")
    for d, t in docs:
        want = np.array(enc.encode_ordinary(t or ""), "<u4")
        assert tuple(got.loc[d]) == (len(want), hashlib.sha256(want.tobytes()).hexdigest(),
                                     hashlib.sha256((t or "").encode()).hexdigest())


def test_pipeline(spark, docs, tmp_path):
    """Each stage against brute force on its own input."""
    import corpus_pipeline

    from wardflow.llm.quality import Bands, _judge
    judge = _judge(Bands())
    frame, now = spark.read.parquet(f"{SF}/documents.parquet"), dict(docs)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frame, SF).write.parquet(f"{tmp_path}/{k}")
        frame = spark.read.parquet(f"{tmp_path}/{k}")
        if k == 0:
            now = {d: t for d, t in now.items() if judge(d, t)[-1]}
        elif k == 1:
            now = {d: t for d, t in now.items() if brute.exact(now.items())[d][0] == d}
        elif k == 2:
            groups = brute.near(list(now.items()), 5, 80)
            now = {d: t for d, t in now.items() if groups[d][1] == d}
        elif k == 3:
            cut = brute.substring(list(now.items()), 20)
            now = {d: t if not cut[d][1] else cut[d][3] for d, t in now.items() if cut[d][1] < cut[d][0]}
        if k < 4:
            assert frame.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert {r.doc_id: r.text for r in frame.collect()} == now
    assert {r.doc_id for r in frame.collect()} == set(now)
