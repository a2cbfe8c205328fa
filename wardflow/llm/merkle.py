"""Merkle dataset manifest with bitmap-rank coordinates (operator 12).

Each group's ids are compressed bitmaps: per bucket of 65,536 ids the non-zero
64-bit words with popcounts before them.  Rank queries on these bitmaps give
every leaf its place in its group without sorting leaves, and slot arrays
keyed by place reduce ten tree levels at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from wardflow.llm.common import Scratch, documents, drop_worker_cache, shuffle_partitions, slices

BITS = 10  # a slot array holds 2^BITS nodes
_NULL_BUCKET = -(1 << 47) - 1  # before the buckets of all ids
_MASK33 = (1 << 33) - 1  # the row number in a partition, of monotonically_increasing_id


def group_key(col: str) -> str:
    """SQL of a group's name as text that sorts bytewise, null first ('-' comes before '=')."""
    return f"coalesce(concat('=', cast({col} AS string)), '-')"


def leaf_hash(columns: list[str]) -> str:
    """SQL of H over columns: ``-`` if null, else the number of UTF-8 bytes, ``:`` and the value."""
    parts = [f"coalesce(concat(octet_length(cast({c} AS string)), ':', cast({c} AS string)), '-')" for c in columns]
    return f"sha2(concat({', '.join(parts)}), 256)"


# ---- coordinates ------------------------------------------------------------

def bitmaps(ids: DataFrame) -> DataFrame:
    """Compressed bitmaps of ``ids`` (g, bucket, pos): g, bucket, total, words.

    Words are counted and or-ed map-side, so a bucket's bitmap is merged from the tasks' partial ones.
    ``words`` are the non-zero ones (no, bits, before, n) in order: ``n`` rows, and
    ``before`` rows of smaller ids in the bucket.  At most 1,024 words a bucket.
    """
    words = ids.groupBy("g", "bucket", F.expr("cast(shiftright(pos, 6) AS int)").alias("no")).agg(
        F.expr("bit_or(shiftleft(1L, cast(pos & 63 AS int)))").alias("bits"), F.count("*").alias("n"))
    prefix = Window.partitionBy("g", "bucket").orderBy("no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = words.withColumn("before", F.sum("n").over(prefix) - F.col("n"))
    return counted.groupBy("g", "bucket").agg(
        F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct("no", "bits", "before", "n"))).alias("words"))


def directory(maps: DataFrame) -> DataFrame:
    """g, bucket, base (rows of the group in smaller buckets) and size (rows of the group).

    Prefix sums over three levels of 16 bits of the bucket number, so that no window holds more
    than 65,537 rows however many buckets a group has.
    """
    low = maps.select("g", "bucket", "total", F.shiftright("bucket", 16).alias("mid"))
    middle = low.groupBy("g", "mid").agg(F.sum("total").alias("total")).withColumn("top", F.shiftright("mid", 16))
    high = middle.groupBy("g", "top").agg(F.sum("total").alias("total"))

    def prefix(df: DataFrame, by: list[str], order: str, name: str) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(name, F.sum("total").over(w) - F.col("total"))
    sizes = Window.partitionBy("g")
    high = prefix(high, ["g"], "top", "h").withColumn("size", F.sum("total").over(sizes)).drop("total")
    middle = prefix(middle, ["g", "top"], "mid", "m").drop("total").join(high, ["g", "top"])
    low = prefix(low, ["g", "mid"], "bucket", "l").drop("total").join(middle, ["g", "mid"])
    return low.select("g", "bucket", F.expr("h + m + l").alias("base"), "size")


def coordinates(leaves: DataFrame, scratch: Scratch) -> DataFrame:
    """``leaves`` (g, id and others) with k, the place in the group by ascending id, and size of the group.

    k is a rank query: rows in smaller buckets, rows in smaller words, and the popcount of smaller bits.
    Null ids come first.  Rows that share an id lie in words of more rows than bits;
    only the rows of such words are dealt by ranges of (g, id, leaf) and numbered.
    """
    spark = leaves.sparkSession
    at = leaves.withColumns({"bucket": F.expr(f"coalesce(shiftright(id, 16), {_NULL_BUCKET}L)"), "pos": F.expr("coalesce(id & 65535L, 0L)")})
    maps = scratch.save(bitmaps(at.select("g", "bucket", "pos")), "bitmaps")
    index = maps.join(directory(maps), ["g", "bucket"]).select("g", "bucket", "base", "size", F.expr("words.no").alias("nos"), "words")
    met = at.join(index.hint("shuffle_hash"), ["g", "bucket"])
    word = met.withColumn("i", F.expr("cast(if(size(nos) = 1024, shiftright(pos, 6), "
                                      "array_position(nos, cast(shiftright(pos, 6) AS int)) - 1) AS int)"))
    ranked = word.select(
        *leaves.columns, "size", F.expr("bucket * 1024 + shiftright(pos, 6)").alias("word"),
        F.expr("words[i].n > bit_count(words[i].bits)").alias("tied"),
        F.expr("base + words[i].before").alias("first"),
        F.expr("bit_count(words[i].bits & ~shiftleft(-1L, cast(pos & 63 AS int)))").alias("below"))
    ranked = scratch.save(ranked, "ranked")
    clear = ranked.where("NOT tied").withColumn("k", F.expr("first + below"))
    shared = ranked.where("tied").withColumn("row_no", F.monotonically_increasing_id())  # deals out equal rows, too
    if shared.isEmpty():
        return clear.select(*leaves.columns, "k", "size")
    numbered = number_rows(shared, ["g", F.col("id").asc_nulls_first(), "leaf", "row_no"], scratch, "ties")
    # a word's rows may span many ranges: its first number, then one row per range and word
    per_range = numbered.groupBy("range", "g", "word").agg(F.min("at").alias("least"))
    firsts = per_range.join(per_range.groupBy("g", "word").agg(F.min("least").alias("start")), ["g", "word"]).drop("least")
    tied = numbered.join(firsts, ["range", "g", "word"]).withColumn("k", F.expr("first + at - start"))
    return clear.select(*leaves.columns, "k", "size").unionByName(tied.select(*leaves.columns, "k", "size"))


def number_rows(df: DataFrame, order: list, scratch: Scratch, name: str) -> DataFrame:
    """``df`` with at (place in ``order``, from 0) and range: dealt by ranges, written, and counted per range."""
    n = shuffle_partitions(df.sparkSession)
    dealt = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    rows = scratch.save(dealt.select("*", F.monotonically_increasing_id().alias("row")), name).withColumn(
        "range", F.shiftright("row", 33))
    # one row a range: bounded by the number of shuffle partitions
    counts = rows.groupBy("range").agg(F.count("*").alias("n"))
    bases = counts.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("base"))
    return rows.join(F.broadcast(bases), "range").withColumn("at", F.expr(f"base + (row & {_MASK33}L)")).drop("row", "base")


# ---- trees --------------------------------------------------------------------

def H(*parts: bytes) -> bytes:
    """Lowercase hex sha256 of the inputs one after another."""
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def height(n: int) -> int:
    """Levels that one slot array of a tree of ``n`` nodes reduces."""
    return min(BITS, max(0, n - 1).bit_length())


def levels(nodes: list[bytes], rounds: int) -> list[list[bytes]]:
    """The nodes and ``rounds`` levels above them; a last run of one node is hashed alone."""
    out = [nodes]
    for _ in range(rounds):
        now = out[-1]
        out.append([H(*now[i:i + 2]) for i in range(0, len(now), 2)])
    return out


def path(tree: list[list[bytes]], slot: int) -> list[tuple[str, bytes]]:
    """(side, sibling) of a slot on each level: the sibling is left (l), right (r), or there is none (-)."""
    out = []
    for nodes in tree[:-1]:
        other = slot ^ 1
        out.append(("-", b"") if other >= len(nodes) else ("l" if other < slot else "r", nodes[other]))
        slot >>= 1
    return out


def fold(leaf: bytes, steps: list[tuple[str, bytes]]) -> bytes:
    """The root that a leaf and its siblings lead to."""
    for side, other in steps:
        leaf = H(leaf) if side == "-" else H(other, leaf) if side == "l" else H(leaf, other)
    return leaf


def write_path(steps: list[tuple[str, bytes]]) -> str:
    return "".join(side + other.decode() for side, other in steps)


def read_path(text: str) -> list[tuple[str, bytes]]:
    out, at = [], 0
    while at < len(text):
        n = 0 if text[at] == "-" else 64
        out.append((text[at], text[at + 1:at + 1 + n].encode()))
        at += 1 + n
    return out


def slot_arrays(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """Nodes (g, size, k, leaf and ``carried``) as one row for each 1,024 places: g, size, node, slots."""
    key = F.shiftright("k", BITS).alias("node")
    slot = F.expr(f"cast(k & {(1 << BITS) - 1} AS int)").alias("slot")
    return nodes.groupBy("g", "size", key).agg(
        F.collect_list(F.struct(slot, F.expr("unhex(leaf)").alias("h"), *carried)).alias("slots"))


def _placed(rows: pa.RecordBatch) -> Iterator[tuple[dict, list[bytes], list[dict]]]:
    """Each row, its node hashes by slot (as hex), and its other slot fields by slot."""
    for r in rows.to_pylist():
        slots: list = [None] * len(r["slots"])
        for s in r["slots"]:
            slots[s["slot"]] = s
        yield r, [s["h"].hex().encode() for s in slots], slots


def tops(arrays: DataFrame) -> DataFrame:
    """The node that each slot array reduces to, as nodes of the next round: g, size, k, leaf."""
    schema = pa.schema([("g", pa.string()), ("size", pa.int64()), ("k", pa.int64()), ("leaf", pa.string())])

    def run(batches):
        drop_worker_cache()
        for rows in slices(batches, 16):
            out = [(r["g"], -(-r["size"] >> BITS) if r["size"] > 1 << BITS else 1, r["node"],
                    levels(nodes, height(r["size"]))[-1][0].decode()) for r, nodes, _ in _placed(rows)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
    slim = arrays.select("g", "size", "node", F.expr("transform(slots, s -> struct(s.slot AS slot, s.h AS h))").alias("slots"))
    return slim.mapInArrow(run, "g STRING, size BIGINT, k BIGINT, leaf STRING")


def build(leaves: DataFrame, carried: list[str], scratch: Scratch, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The slot arrays of each round, from the leaves up, and the root of every group (g, root).

    ``leaves`` have g, size, k, leaf.  A round reduces ten levels, so a group of n leaves takes log1024(n) rounds.
    """
    rounds, roots, nodes = [], [], leaves
    while True:
        rounds.append(scratch.save(slot_arrays(nodes, carried if not rounds else []), f"{name}-slots-{len(rounds)}"))
        now = scratch.save(tops(rounds[-1]), f"{name}-tops-{len(rounds)}")
        roots.append(now.where("size = 1").select("g", F.col("leaf").alias("root")))
        nodes = now.where("size > 1")
        if nodes.isEmpty():
            return rounds, reduce(DataFrame.unionAll, roots)


def descend(rounds: list[DataFrame], upper: DataFrame, emit: Callable, ddl: str, schema: pa.Schema) -> DataFrame:
    """Carry the paths above each group's root down to its leaves.

    ``upper`` has g, path (from the group's root on) and any constant columns; ``emit(row, nodes,
    slots, tree)`` gives the output rows of one slot array of leaves.
    """
    constant = [c for c in upper.columns if c not in ("g", "path")]
    inner = pa.schema([("g", pa.string()), ("node", pa.int64()), ("path", pa.string()), *[(c, pa.string()) for c in constant]])

    def below(row, nodes, slots, tree):
        # the place of a node among all of its round names the slot array it came from
        return [(row["g"], (row["node"] << BITS) + i, write_path(path(tree, i)) + row["path"], *[row[c] for c in constant])
                for i in range(len(nodes))]

    def apply(arrays: DataFrame, f: Callable, out_ddl: str, out: pa.Schema) -> DataFrame:
        def run(batches):
            drop_worker_cache()
            for rows in slices(batches, 4):
                got = [x for r, nodes, slots in _placed(rows) for x in f(r, nodes, slots, levels(nodes, height(r["size"])))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*got), out)], schema=out)
        return arrays.mapInArrow(run, out_ddl)
    inner_ddl = ", ".join(["g STRING", "node BIGINT", "path STRING", *[f"{c} STRING" for c in constant]])
    known = None
    for r in range(len(rounds) - 1, -1, -1):
        arrays = rounds[r]
        last = arrays.where(f"size <= {1 << BITS}").join(upper, "g")  # their top is the group's root
        if known is not None:
            last = last.unionByName(arrays.where(f"size > {1 << BITS}").join(known, ["g", "node"]))
        known = apply(last, below, inner_ddl, inner) if r else apply(last, emit, ddl, schema)
    return known


_NAMED = pa.schema([("g", pa.string()), ("path", pa.string()), ("subroot", pa.string()), ("root", pa.string())])
PROOF_DDL = ("id BIGINT, leaf STRING, subroot STRING, root STRING, proof STRING, proof_sha256 STRING, "
             "folded_root STRING, verified BOOLEAN")
_PROOF = pa.schema([("id", pa.int64()), *[(c, pa.string()) for c in ("leaf", "subroot", "root", "proof", "proof_sha256", "folded_root")],
                    ("verified", pa.bool_())])


def manifest(leaves: DataFrame, proofs: bool = True) -> DataFrame:
    """Roots, proofs and verdicts of ``leaves`` (g, id, leaf, claim): one row per leaf.

    ``leaf`` is the hash that the manifest holds and ``claim`` the one to be verified (null: the
    leaf itself).  Per group, leaves ascend by id (null first; rows of one id by leaf), and
    groups ascend by g; every two nodes become their H, a last one alone, too, until one is left.
    Returns id, leaf, subroot, root, proof (side and hex of each sibling, or - for none; null
    unless ``proofs``), proof_sha256 (H of the siblings), folded_root (of the claim and the
    siblings) and verified.  Rows that repeat id and leaf are leaves of their own.
    """
    spark = leaves.sparkSession
    scratch = Scratch(spark, "merkle")
    placed = coordinates(leaves, scratch)
    rounds, subroots = build(placed, ["id", "claim"], scratch, "leaves")
    groups = number_rows(subroots.withColumnRenamed("g", "name"), ["name"], scratch, "groups")
    n_groups = groups.count()
    top = groups.select(F.lit("").alias("g"), F.lit(n_groups).cast("bigint").alias("size"), F.col("at").alias("k"),
                        F.col("root").alias("leaf"), "name")
    top_rounds, root = build(top, ["name"], scratch, "groups")

    def name_group(row, nodes, slots, tree):
        return [(slots[i]["name"], write_path(path(tree, i)) + row["path"], nodes[i].decode(), row["root"]) for i in range(len(nodes))]
    above = descend(top_rounds, root.select("g", F.lit("").alias("path"), "root"), name_group,
                    "g STRING, path STRING, subroot STRING, root STRING", _NAMED)

    def prove(row, nodes, slots, tree):
        rest, out = read_path(row["path"]), []
        for i, leaf in enumerate(nodes):
            steps = path(tree, i) + rest
            claim = slots[i]["claim"]
            folded = fold(claim.encode() if claim else leaf, steps).decode()
            out.append((slots[i]["id"], leaf.decode(), row["subroot"], row["root"], write_path(steps) if proofs else None,
                        H(*[other for _, other in steps]).decode(), folded, folded == row["root"]))
        return out
    return descend(rounds, scratch.save(above, "above"), prove, PROOF_DDL, _PROOF)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a leaf of the manifest, verified after its n_chars may have been tampered with."""
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = [c if c != "n_chars" else "try_add(n_chars, 1)" for c in columns]
    leaves = documents(spark, sf_dir).select(
        F.expr(group_key("lang")).alias("g"), F.col("doc_id").alias("id"), F.expr(leaf_hash(columns)).alias("leaf"),
        F.expr(f"if(crc32(cast(doc_id AS string)) % 7 = 0, {leaf_hash(tampered)}, null)").alias("claim"))
    return manifest(leaves, proofs=False).drop("proof").withColumnRenamed("id", "doc_id")


_FIELD = "coalesce(octet_length(encode(CAST({0} AS VARCHAR))) || ':' || CAST({0} AS VARCHAR), '-')"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


# crc32 of the decimal doc_id, bit by bit (the polynomial is a fixed value)
_CRC = """xor(4294967295, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda acc, b: list_reduce(list_transform(range(8), lambda i: CAST(i AS BIGINT)),
        lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(acc, b)), 4294967295))"""
OP12_SQL = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, lang, {_leaf_sql('n_chars')} AS leaf,
           CASE WHEN {_CRC} % 7 = 0 THEN {_leaf_sql('n_chars + 1')} ELSE {_leaf_sql('n_chars')} END AS claim,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS k,
           dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
           count(*) OVER (PARTITION BY lang) AS size
    FROM documents),
low(g, lvl, k, n, h) AS (
    SELECT g, 0, k, size, leaf FROM d
    UNION ALL
    SELECT g, lvl + 1, k // 2, (n + 1) // 2, sha256(h || coalesce(after, ''))
    FROM (SELECT *, lead(h) OVER (PARTITION BY g ORDER BY k) AS after FROM low WHERE n > 1) WHERE k % 2 = 0),
sub AS (SELECT g, lvl AS height, h AS subroot FROM low WHERE n = 1),
high(lvl, k, n, h) AS (
    SELECT 0, g, (SELECT count(*) FROM sub), subroot FROM sub
    UNION ALL
    SELECT lvl + 1, k // 2, (n + 1) // 2, sha256(h || coalesce(after, ''))
    FROM (SELECT *, lead(h) OVER (ORDER BY k) AS after FROM high WHERE n > 1) WHERE k % 2 = 0),
top AS (SELECT lvl AS height, h AS root FROM high WHERE n = 1),
up AS (
    SELECT d.g, d.k, s.lvl, s.h AS other, s.k < (d.k >> s.lvl) AS is_left FROM d JOIN low s
        ON s.g = d.g AND s.n > 1 AND s.k = xor(d.k >> s.lvl, 1)
    UNION ALL
    SELECT d.g, d.k, sub.height + s.lvl, s.h, s.k < (d.g >> s.lvl) FROM d JOIN sub ON sub.g = d.g JOIN high s
        ON s.n > 1 AND s.k = xor(d.g >> s.lvl, 1)),
proof AS (SELECT g, k, string_agg(other, '' ORDER BY lvl) AS siblings FROM up GROUP BY g, k),
folds(g, k, lvl, h) AS (
    SELECT g, k, 0, claim FROM d
    UNION ALL
    SELECT f.g, f.k, f.lvl + 1, sha256(CASE WHEN up.is_left THEN up.other || f.h ELSE f.h || coalesce(up.other, '') END)
    FROM folds f JOIN sub ON sub.g = f.g CROSS JOIN top LEFT JOIN up ON up.g = f.g AND up.k = f.k AND up.lvl = f.lvl
    WHERE f.lvl < sub.height + top.height)
SELECT d.doc_id, d.leaf, sub.subroot, top.root, sha256(coalesce(proof.siblings, '')) AS proof_sha256,
       folds.h AS folded_root, folds.h = top.root AS verified
FROM d JOIN sub ON sub.g = d.g CROSS JOIN top LEFT JOIN proof ON proof.g = d.g AND proof.k = d.k
JOIN folds ON folds.g = d.g AND folds.k = d.k AND folds.lvl = sub.height + top.height
"""
