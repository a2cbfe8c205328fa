"""Operator 13 against exhaustive scoring."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from wardflow.llm import signatures as S
from wardflow.session import shared_dir

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def brute(docs, queries, k):
    """Sorted (item_id, rank, doc_id, score)."""
    tf = [(d, Counter(words(t))) for d, t in docs]
    tf = [(d, c, sum(c.values())) for d, c in tf if c]
    N, L = len(tf), sum(n for _, _, n in tf)
    df = Counter(w for _, c, _ in tf for w in c)
    asked = {}
    for item, text in queries:
        asked.setdefault(item, set()).update(words(text))
    out = []
    for item, ws in asked.items():
        weight = {w: math.floor(1000 * math.log((2 * N + 2) / (2 * df[w] + 1))) for w in ws if df[w]}
        got = []
        for d, c, n in tf:
            m = 100 - 50 + (50 * n * N) // L
            score = sum(x * ((1_000_000_000 * c[w]) // (1000 * c[w] + 20 * m)) for w, x in weight.items() if c[w])
            if score > 0:
                got.append((-score, d is None, d or 0, d))
        got.sort(key=lambda g: g[:3])
        out += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(got[:k])]
    return sorted(out, key=repr)


def check(spark, docs, queries, k=5, **kw):
    index = S.build_index(spark.createDataFrame(docs, "doc_id BIGINT, text STRING").repartition(3), shared_dir(spark, "sig-test"))
    got = S.search(index, spark.createDataFrame(queries, "item_id BIGINT, text STRING"), k, **kw).collect()
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got), key=repr) == brute(docs, queries, k)
    return index


def corpus(n, seed, longest=400):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)] + ["Été", "naïve", "東京", "x1"]
    return [(i, " ".join(rng.choices(vocab, weights=[1 / (j + 1) for j in range(len(vocab))], k=rng.randrange(1, longest))))
            for i in range(n)], vocab, rng


@pytest.mark.parametrize("slab_entries", [1, 7, 1 << 14])
def test_against_brute_force(spark, slab_entries):
    docs, vocab, rng = corpus(400, 4)
    queries = [(i, " ".join(rng.choices(vocab, k=8)) + " unseen!") for i in range(12)]
    check(spark, docs, queries, slab_entries=slab_entries)


def test_edges(spark):
    """Nulls, empty and very long texts, ties, repeated rows and ids, a frequent word, words next to marks, items of one id."""
    docs = [(1, None), (2, ""), (3, "?! --"), (4, "Same text"), (5, "same TEXT"), (5, "same text"), (None, "same text"),
            (6, "a-b_c.d e\tf\x00g ÀÉ é1é"), (7, "long " * 50_000 + "tail"), (8, "rare"), (9, " ".join(f"t{i}" for i in range(30_000)))]
    docs += [(100 + i, "same") for i in range(60)]
    queries = [(1, "same TEXT"), (2, None), (3, ""), (4, "unseen"), (5, "tail long t7"), (None, "rare"), (None, "text"), (1, "rare"),
               (6, "àé ÀÉ É1É é1é f g b_c"), (7, " ".join(f"t{i}" for i in range(5000)))]
    check(spark, docs, queries)
    check(spark, docs, queries, k=50)
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id BIGINT, text STRING, n_docs BIGINT, term STRING")
    assert S.build_index(frame, shared_dir(spark, "sig-test")).agg({"n_docs": "sum"}).first()[0] == len(docs) - 3


def test_empty(spark):
    docs, queries = "doc_id BIGINT, text STRING", "item_id BIGINT, text STRING"
    none = S.build_index(spark.createDataFrame([], docs), shared_dir(spark, "sig-test"))
    assert S.search(none, spark.createDataFrame([(1, "a")], queries)).count() == 0
    index = S.build_index(spark.createDataFrame([(1, "a")], docs), shared_dir(spark, "sig-test"))
    got = S.search(index, spark.createDataFrame([], queries))
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == 0


def test_bounds_hold_and_exclude(spark):
    """No score passes its bound, and most documents are excluded without being rescored."""
    docs, vocab, rng = corpus(3000, 9)
    builder, blocks = S.BlockBuilder(), []
    for d, t in docs:
        if b := builder.add(d, t):
            blocks.append(S._batch(b))
    blocks += map(S._batch, builder.close_all())
    total = S.Collection(len(docs), sum(len(words(t)) for _, t in docs))
    asked = sorted(rng.sample(vocab, 40), key=str)
    asked = sorted({w for a in asked for w in words(a)})
    entries = np.array([rng.randrange(len(asked)) for _ in range(60)])
    slab = S.Slab(list(range(10)), asked, S.hash_terms([w.encode() for w in asked]), entries,
                  np.array([rng.randrange(1, 9000) for _ in entries]), np.arange(0, 60, 6))
    best, rescored = S.Best(10, 5), 0
    for row in blocks:
        block = S.Block(row, total)
        most = block.most(slab.hashes)
        exact = block.exact(pa.array(asked), np.arange(block.n))
        assert (most >= exact).all() and (most > 0).mean() < 0.6
        rescored += S.search_block(block, slab, pa.array(asked), best)
    assert rescored < 0.5 * 10 * len(docs)
