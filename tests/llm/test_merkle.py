"""Operator 12 against a plain Merkle tree."""

from __future__ import annotations

import hashlib
import random

import pytest

from wardflow.llm import merkle as M
from wardflow.llm.common import Scratch

DDL = "g STRING, id BIGINT, leaf STRING, claim STRING"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    """(root, siblings of each node from the bottom up, None where there is none)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            paths[i].append((k & 1, nodes[k ^ 1]) if k ^ 1 < len(nodes) else None)
            at[i] = k >> 1
        nodes = [H(*nodes[k:k + 2]) for k in range(0, len(nodes), 2)]
    return nodes[0], paths


def brute(rows):
    """Sorted (id, leaf, subroot, root, proof_sha256, folded_root, verified)."""
    groups = {}
    for g, i, leaf, claim in rows:
        groups.setdefault(g, []).append((i is not None, i or 0, leaf, i, claim))
    trees, order = {}, sorted(groups, key=lambda g: g.encode())
    for g in order:
        groups[g].sort(key=lambda r: r[:3])
        trees[g] = tree([r[2] for r in groups[g]])
    root, above = tree([trees[g][0] for g in order])
    out = []
    for g, up in zip(order, above):
        for (_, _, leaf, i, claim), path in zip(groups[g], trees[g][1]):
            now = claim or leaf
            for step in path + up:
                now = H(now) if step is None else H(step[1], now) if step[0] else H(now, step[1])
            out.append((i, leaf, trees[g][0], root, H(*[s[1] for s in path + up if s]), now, now == root))
    return sorted(out, key=repr)


def check(spark, rows):
    got = M.manifest(spark.createDataFrame(rows, DDL), proofs=True).collect()
    assert sorted(((r.id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in got), key=repr) == brute(rows)
    for r in got:  # the proof itself leads from the leaf to the root
        steps = M.read_path(r.proof)
        assert M.fold(r.leaf.encode(), steps).decode() == r.root
        assert M.H(*[other for _, other in steps]).decode() == r.proof_sha256
    return got


def leaves(pairs, seed=1):
    rng = random.Random(seed)
    return [(g, i, H(g, str(i), str(rng.random())), H("other", str(i)) if rng.random() < 0.1 else None) for g, i in pairs]


def test_small_trees(spark):
    """Groups of 1 to 9 leaves, in a tree of groups."""
    check(spark, leaves([(f"=g{n}", i * 7) for n in range(1, 10) for i in range(n)]))


def test_one_leaf(spark):
    (only,) = check(spark, [("-", None, H("x"), None)])
    assert only.leaf == only.root == only.subroot and only.proof == "" and only.verified


def test_several_rounds(spark):
    """More than 1,024 leaves in a group and more than 1,024 groups; ids over the whole range of BIGINT."""
    rng = random.Random(3)
    ids = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(700)] + list(range(-40, 1500)) + [(1 << 63) - 1, -(1 << 63), 1 << 40]
    pairs = [("=big", i) for i in dict.fromkeys(ids)] + [(f"={n:04d}", n) for n in range(1100)] + [("-", 5)]
    rows = leaves(pairs)
    rng.shuffle(rows)
    check(spark, rows)


def test_ties_and_nulls(spark):
    """Repeated ids, repeated rows and null ids; other ids of the same word keep their places."""
    rows = leaves([("=a", i) for i in range(100)] + [("=a", 7)] * 5 + [("=a", None)] * 9 + [("-", 3)] * 40 + [("-", 4)])
    rows += rows[:3] * 2 + [("=b", 1, H("same"), H("claim"))] * 1500
    random.Random(2).shuffle(rows)
    check(spark, rows)


def test_empty(spark):
    assert M.manifest(spark.createDataFrame([], DDL)).count() == 0


def test_leaf_hash_and_group_key(spark):
    """Nulls, empty texts, byte counts and clashing column names."""
    rows = spark.createDataFrame([(1, None, "é"), (None, "", "1:1")], "g BIGINT, leaf STRING, word STRING")
    got = rows.selectExpr(M.leaf_hash(["g", "leaf", "word"]) + " AS h", M.group_key("leaf") + " AS k").collect()
    assert [tuple(r) for r in got] == [(H("1:1", "-", "2:é"), "-"), (H("-", "0:", "3:1:1"), "=")]


@pytest.mark.parametrize("n", [1, 5, 64])
def test_bitmaps_and_directory(spark, n):
    """Ranks equal positions in sorted order, for any number of buckets."""
    rng = random.Random(n)
    ids = sorted({rng.randrange(1 << (10 + n // 2)) << (n // 3) for _ in range(500)})
    frame = spark.createDataFrame([("x", i, f"{i}") for i in ids], "g STRING, id BIGINT, leaf STRING")
    got = M.coordinates(frame, Scratch(spark, "merkle-test")).collect()
    assert {r.id: r.k for r in got} == {i: k for k, i in enumerate(ids)}
    assert {r["size"] for r in got} == {len(ids)}
