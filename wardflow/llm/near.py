"""MinHash near-duplicates by tensored banding (operator 6).

Two small collections of minhash tuples are drawn per document; a table key
combines one tuple of each, so ``m`` + ``m`` tuples make ``m * m`` tables.
Candidates are confirmed on full shingle sets.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from wardflow.llm.common import Scratch, documents, drop_worker_cache, map_rows, shuffle_partitions, slices, word_hashes
from wardflow.llm.graph import merge_components

_NO_ID = -(1 << 63)  # a null doc_id


@dataclass(frozen=True)
class Tensor:
    """``m`` tuples of ``r`` minhashes in each of the two collections.

    A pair of similarity s shares a key with probability (1 - (1 - s^r)^m)^2:
    0.9996 at s = 0.8 and 4e-9 at s = 0.01 for the defaults, from 72 minhashes
    where 144 independent tables of six would need 864.
    """
    m: int = 12
    r: int = 3
    seed: int = 20


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of ``width`` words; A-Z count as a-z.

    With fewer words the whole sequence is one shingle; without words there is none.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    one = word_hashes(words)
    k = min(width, len(words))
    h = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + one[i:len(words) - k + 1 + i])
    return np.unique(h)


def _tuples(s: np.ndarray, factors: np.ndarray, r: int) -> np.ndarray:
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), 2048):
        least = np.minimum(least, (s[i:i + 2048, None] * factors).min(axis=0))
    key = np.zeros(len(factors) // r, np.uint64)
    for part in least.reshape(-1, r).T:
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + part)
    return key.view(np.int64)


def signatures(docs: DataFrame, width: int, tensor: Tensor) -> DataFrame:
    """node (doc_id), n (set size), cid (128-bit digest of the set), and the two collections a and b."""
    schema = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("cid", pa.binary()),
                        ("a", pa.list_(pa.int64())), ("b", pa.list_(pa.int64()))])
    half = tensor.m * tensor.r

    def make():
        factors = np.random.default_rng(tensor.seed).integers(0, 1 << 63, 2 * half, np.uint64) * np.uint64(2) + np.uint64(1)

        def step(rows: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for doc, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                s = shingles(text, width)
                keys = _tuples(s, factors, tensor.r)
                out.append((_NO_ID if doc is None else doc, len(s), xxhash.xxh3_128_digest(s.tobytes()),
                            keys[:tensor.m], keys[tensor.m:]))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        return step
    return map_rows(docs.select("doc_id", "text"), make, "node BIGINT, n BIGINT, cid BINARY, a ARRAY<BIGINT>, b ARRAY<BIGINT>")


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """node, cid and the whole shingle set s of each row."""
    schema = pa.schema([("node", pa.int64()), ("cid", pa.binary()), ("s", pa.list_(pa.int64()))])

    def make():
        def step(rows: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingles(t, width) for t in rows.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                 pa.array([s.view(np.int64) for s in sets], schema.field("s").type)], schema=schema)
        return step
    return map_rows(docs, make, "node BIGINT, cid BINARY, s ARRAY<BIGINT>")


def _shared(classes: DataFrame, side: str) -> DataFrame:
    """Tuples of one collection that several classes have, gathered per class again."""
    flat = classes.select("node", F.posexplode(side).alias("i", "x"))
    often = flat.groupBy("i", "x").agg(F.count("*").alias("c")).where("c > 1").select("i", "x")
    return flat.join(often, ["i", "x"], "left_semi").groupBy("node").agg(
        F.collect_list(F.struct("i", "x")).alias(side))  # at most m entries


def table_heads(classes: DataFrame) -> DataFrame:
    """node and heads: the smallest members of all table keys that a class shares with others.

    A key can only be shared if both of its tuples are, so keys are formed of
    shared tuples alone.
    """
    keys = (_shared(classes, "a").join(_shared(classes, "b"), "node")
            .select("node", F.explode("a").alias("p"), "b").select("node", "p", F.explode("b").alias("q"))
            .select("node", F.xxhash64("p.i", "p.x", "q.i", "q.x").alias("key")))
    first = keys.groupBy("key").agg(F.min("node").alias("x"), F.max("node").alias("z")).where("x < z").select("key", "x")
    return keys.join(first, "key").groupBy("node").agg(F.array_sort(F.collect_set("x")).alias("heads"))  # at most m * m


def families(heads: DataFrame, scratch: Scratch) -> DataFrame:
    """node and label of the components that shared table keys form.

    A member is tied to its smallest head alone, and that head to the member's other heads; the
    label steps run over the heads only, whose links are few however large a family is.
    """
    links = (heads.where("size(heads) > 1").select(F.expr("heads[0]").alias("x"), F.explode(F.expr("slice(heads, 2, size(heads) - 1)")).alias("y"))
             .distinct())
    links = scratch.save(links, "head-links")
    alone = heads.select(F.explode("heads").alias("node")).distinct().withColumn("label", F.col("node"))
    labels = merge_components(scratch.save(alone, "table-heads"), links, scratch, "families")
    return heads.select("node", F.expr("heads[0]").alias("head")).join(
        labels.withColumnRenamed("node", "head"), "head").select("node", "label")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) whose full sets have 100 * intersection >= percent * union."""
    left = pairs.join(sets.select(F.col("node").alias("x"), F.col("s").alias("sx")), "x")
    both = left.join(sets.select(F.col("node").alias("y"), F.col("s").alias("sy")), "y")
    common = both.select("x", "y", F.expr("size(array_intersect(sx, sy))").alias("c"),
                         F.expr("size(sx) + size(sy)").alias("total"))
    return common.where(f"100 * c >= {percent} * (total - c)").select("x", "y")


def _size_class(n: str) -> str:
    """Sets of a similarity of 0.8 or more lie in the same or in adjacent classes."""
    return f"cast(floor(ln({n}) / ln(1.25) + 1e-9) AS int)"


def _blocks(members: DataFrame, block: int) -> DataFrame:
    """Deal each family out to groups that compare a block of its stragglers with a block of its members.

    ``members`` has family, node, label and n; a straggler is a member outside the
    component of the family's first member.  Blocks hold about ``block``
    sets of one size class, and only blocks of the same or adjacent classes meet, so a
    member is sent once per block of stragglers of like size, never once per straggler.
    Returns g (group), ask (block of stragglers or of members), node and label.
    """
    m = members.withColumns({"c": F.expr(_size_class("n")), "straggler": F.expr("label <> family")})
    sizes = (m.groupBy("family", "c").agg(F.count("*").alias("all"), F.count(F.when(F.col("straggler"), 1)).alias("q"))
             .groupBy("family").agg(F.collect_list(F.struct("c", F.ceil(F.col("all") / block).cast("int").alias("all"),
                                                            F.ceil(F.col("q") / block).cast("int").alias("q"))).alias("sizes"),
                                    F.sum("q").alias("open"))  # one entry per size class
             .where("open > 0"))
    near = m.join(sizes, "family").withColumn("near", F.expr("filter(sizes, x -> abs(x.c - c) <= 1)")).withColumn(
        "own", F.expr("filter(sizes, x -> x.c = c)[0]")).withColumn("h", F.expr("xxhash64(node, 3)"))
    group = "xxhash64(family, {qc}, {qh}, {mc}, {mh})"
    asked = near.where("straggler").select("node", "label", F.lit(True).alias("ask"), F.expr(
        "explode(flatten(transform(near, x -> transform(sequence(0, x.all - 1), k -> "
        + group.format(qc="c", qh="pmod(h, own.q)", mc="x.c", mh="cast(k AS bigint)") + "))))").alias("g"))
    met = near.select("node", "label", F.lit(False).alias("ask"), F.expr(
        "explode(flatten(transform(filter(near, x -> x.q > 0), x -> transform(sequence(0, x.q - 1), k -> "
        + group.format(qc="x.c", qh="cast(k AS bigint)", mc="c", mh="pmod(h, own.all)") + "))))").alias("g"))
    return asked.unionByName(met)


def compare_block(ask: np.ndarray, nodes: list[int], labels: list[int], sets: list[np.ndarray], percent: int):
    """Links that join the components of two blocks, as (x, y): a spanning set, not all pairs.

    All intersections of the asked with the other sets come from products of 0/1 matrices over
    shingles that at least two sets have.
    """
    index = {n: i for i, n in enumerate(dict.fromkeys(nodes))}
    at = np.array([index[n] for n in nodes])
    first = np.unique(at, return_index=True)[1]
    own = [sets[i] for i in first]
    label = np.array([labels[i] for i in first], np.int64)
    size = np.array([len(s) for s in own])
    which, column = np.unique(np.concatenate(own), return_inverse=True)
    row = np.repeat(np.arange(len(own)), size)
    count = np.bincount(column, minlength=len(which))
    common = np.flatnonzero(count > 1)
    renumber = np.full(len(which), -1)
    renumber[common] = np.arange(len(common))
    column = renumber[column]
    row, column = row[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    q, m = np.unique(at[ask]), np.unique(at[~ask])
    shared = np.zeros((len(q), len(m)), np.float32)
    for lo in range(0, len(common), 2048):
        a, b = np.searchsorted(column, [lo, lo + 2048])
        dense = np.zeros((len(own), min(2048, len(common) - lo)), np.float32)
        dense[row[a:b], column[a:b] - lo] = 1
        shared += dense[q] @ dense[m].T
    union = size[q][:, None] + size[m][None, :] - shared
    qi, mi = np.nonzero((100 * shared >= percent * union) & (label[q][:, None] != label[m][None, :]))
    names = np.array(list(index), np.int64)
    parent: dict[int, int] = {}

    def root(v):
        while parent.setdefault(v, v) != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v
    out = []
    for a, b in zip(q[qi].tolist(), m[mi].tolist()):
        x, y = root(int(label[a])), root(int(label[b]))
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((int(names[a]), int(names[b])))
    return out


def _compare(blocks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Run ``compare_block`` on every group; a partition holds whole groups, one in memory at a time."""
    schema = pa.schema([("x", pa.int64()), ("y", pa.int64())])

    def run(batches):
        drop_worker_cache()
        held: list[tuple] = []

        def links():
            _, ask, nodes, labels, got = zip(*held)
            pairs = compare_block(np.array(ask), list(nodes), list(labels), list(got), percent)
            return pa.RecordBatch.from_pydict({"x": [p[0] for p in pairs], "y": [p[1] for p in pairs]}, schema=schema)
        for batch in slices(batches):
            g, ask, node, label = (batch.column(i).to_pylist() for i in range(4))
            s = batch.column(4)
            for i in range(batch.num_rows):
                if held and held[-1][0] != g[i]:
                    yield links()
                    held.clear()
                held.append((g[i], ask[i], node[i], label[i], s[i].values.to_numpy()))
        if held:
            yield links()
    rows = blocks.join(sets, "node").select("g", "ask", "node", "label", "s")
    dealt = rows.repartition(shuffle_partitions(sets.sparkSession), "g").sortWithinPartitions("g")
    return dealt.mapInArrow(run, "x BIGINT, y BIGINT")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, tensor: Tensor = Tensor(),
                    block: int = 1024) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Equal sets are one class, represented by its smallest doc_id; so copies
    meet no table.  Shared table keys join classes to families.  Every member is confirmed
    against the family's first member on full sets; members that this leaves outside
    its component are then compared in blocks with all members of like size, so no pair that shares a key goes
    unconfirmed unless it is in one component already.  ``percent`` is at least 80.
    Texts without words have no link.  Rows of one doc_id are one document; null ids are one too.
    """
    if percent < 80:
        raise ValueError("size classes are made for similarities of 80 % and more")
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    sig = scratch.save(signatures(docs, width, tensor), "signatures")
    by_set = sig.where("n > 0").groupBy("cid").agg(
        F.min("node").alias("node"), F.any_value("n").alias("n"), F.any_value("a").alias("a"), F.any_value("b").alias("b"))
    classes = scratch.save(by_set, "classes")
    family = scratch.save(families(scratch.save(table_heads(classes), "heads"), scratch), "family")
    alone = family.select("node", F.col("node").alias("label"))
    wanted = classes.select("node", "cid").join(alone, "node", "left_semi")
    texts = docs.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("node"), "text").join(alone, "node", "left_semi")
    found = full_sets(texts, width).join(wanted, ["node", "cid"], "left_semi")
    sets = scratch.save(found.dropDuplicates(["node", "cid"]).select("node", "s"), "sets")
    n = classes.groupBy("node").agg(F.max("n").alias("n"))
    members = scratch.save(family.withColumnRenamed("label", "family").join(n, "node"), "members")
    heads = members.where("node = family").select("family", F.col("n").alias("k"))
    with_head = (members.where("node <> family").join(heads, "family")
                 .where(f"100 * least(n, k) >= {percent} * greatest(n, k)").select(F.col("family").alias("x"), F.col("node").alias("y")))
    confirmed = _confirm(with_head, sets, percent).select(F.col("y").alias("node"), "x")
    # a family's first member is its smallest, so a confirmed member has its label at once
    labels = scratch.save(alone.join(confirmed, "node", "left").select("node", F.coalesce("x", "label").alias("label")), "confirmed")
    rest = _compare(_blocks(members.join(labels, "node"), block), sets, percent)
    labels = merge_components(labels, scratch.save(rest, "block-links"), scratch, "blocks")
    # classes without a family, and texts without words, keep their own first member
    owner = classes.select("cid", F.col("node").alias("first")).join(labels.withColumnRenamed("node", "first"), "first", "left")
    owner = owner.select("cid", F.coalesce("label", "first").alias("label"))
    shown = sig.select("node", "n", F.when(F.col("n") > 0, F.col("cid")).alias("cid")).join(owner, "cid", "left")
    return (shown.withColumn("label", F.coalesce("label", "node"))
            .select(F.expr(f"nullif(node, {_NO_ID + 1}L - 1L)").alias("doc_id"), F.col("n").alias("n_shingles"),
                    F.expr(f"nullif(label, {_NO_ID + 1}L - 1L)").alias("component_id"),
                    F.expr("node = label").alias("kept")))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the smallest doc_id that links of 80 % on word pairs reach."""
    return near_duplicates(documents(spark, sf_dir), width=2, percent=80)
