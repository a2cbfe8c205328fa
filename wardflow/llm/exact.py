"""Exact deduplication by Patricia tries (operator 3).

Texts are dealt to tasks by (length, content hash) of their normalised bytes.
Each task inserts the full byte strings into compressed radix tries whose
terminal nodes hold the owner of the text: the member with the best rank and
the number of members.  A trie over its memory budget spills whole subtrees.
"""

from __future__ import annotations

import os
import pickle
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from wardflow.llm.common import documents, drop_worker_cache, shuffle_partitions, slices

Owner = tuple[int, int, int, int]  # (-code points of the original, doc_id, members, hash of the text)


def _merge(a: Owner, b: Owner) -> Owner:
    return (*min(a[:2], b[:2]), a[2] + b[2], a[3])


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving with slice comparisons."""
    lo, hi = 0, min(len(a), len(b))
    if a[:hi] == b[:hi]:
        return hi
    while lo < hi - 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo if a[lo:lo + 1] != b[lo:lo + 1] else lo + 1


class Node:
    """A trie node: the bytes on its incoming edge, children by first byte, and its owner if terminal."""
    __slots__ = ("edge", "kids", "owner")

    def __init__(self, edge: bytes, kids: dict, owner: Owner | None):
        self.edge, self.kids, self.owner = edge, kids, owner


class PatriciaTrie:
    """Compressed radix trie from byte strings to owners."""

    def __init__(self):
        self.root = Node(b"", {}, None)
        self.size = 0  # bytes on edges, with an allowance for each node
        self.keys = 0

    def insert(self, key: bytes, owner: Owner) -> None:
        node, at = self.root, 0
        while at < len(key):
            kid = node.kids.get(key[at])
            if kid is None:
                node.kids[key[at]] = Node(key[at:], {}, owner)
                self.size += len(key) - at + 300
                self.keys += 1
                return
            rest = key[at:at + len(kid.edge)]
            if rest == kid.edge:
                node, at = kid, at + len(rest)
                continue
            cut = _shared(rest, kid.edge)
            node.kids[key[at]] = upper = Node(kid.edge[:cut], {kid.edge[cut]: kid}, None)
            kid.edge = kid.edge[cut:]
            self.size += 300
            node, at = upper, at + cut
        self.keys += node.owner is None
        node.owner = owner if node.owner is None else _merge(node.owner, owner)

    def branching(self) -> bytes:
        """The prefix that all keys share."""
        node, prefix = self.root, b""
        while node.owner is None and len(node.kids) == 1:
            (node,) = node.kids.values()
            prefix += node.edge
        return prefix

    def items(self) -> Iterator[tuple[bytes, Owner]]:
        stack = [(self.root, b"")]
        while stack:
            node, prefix = stack.pop()
            if node.owner is not None:
                yield prefix + node.edge, node.owner
            stack += [(k, prefix + node.edge) for k in node.kids.values()]


class SpillingTrie:
    """Owners of texts within a memory budget.

    Above the budget the subtrees below the first branching are appended to one local file each, named by the byte
    that leads to them, and freed; keys that turn out not to share the prefix of that branching have a file of their own.  At the end the files
    are read back one after another, and one that is again over the budget is split further down.  As a branching
    parts at least two keys, this ends with any budget; a trie of one key is never spilled, so
    the memory is the budget and the longest two texts.  The files vanish with the task.
    """

    def __init__(self, budget: int, folder: tempfile.TemporaryDirectory | None = None):
        self.budget, self.folder = budget, folder
        self.trie = PatriciaTrie()
        self.prefix: bytes | None = None   # of the branching that names the files
        self.files: dict[str, str] = {}

    def insert(self, key: bytes, owner: Owner) -> None:
        self.trie.insert(key, owner)
        if self.trie.size > self.budget and self.trie.keys > 1:
            self._spill()

    def _name(self, key: bytes) -> str:
        if not key.startswith(self.prefix):
            return "other"
        return str(key[len(self.prefix)]) if len(key) > len(self.prefix) else "end"

    def _spill(self) -> None:
        if self.folder is None:
            self.folder = tempfile.TemporaryDirectory(prefix="trie-")
        if self.prefix is None:
            self.prefix = self.trie.branching()
        handles = {}
        try:
            for key, owner in self.trie.items():
                name = self._name(key)
                if name not in self.files:
                    self.files[name] = os.path.join(self.folder.name, uuid.uuid4().hex)
                if name not in handles:
                    handles[name] = open(self.files[name], "ab")
                pickle.dump((key, owner), handles[name], pickle.HIGHEST_PROTOCOL)
        finally:
            for f in handles.values():
                f.close()
        self.trie = PatriciaTrie()

    def items(self) -> Iterator[tuple[bytes, Owner]]:
        if not self.files:
            yield from self.trie.items()
            return
        self._spill()
        todo = list(self.files.values())
        while todo:
            path = todo.pop()
            part = SpillingTrie(self.budget, self.folder)
            with open(path, "rb") as f:
                while True:
                    try:
                        entry = pickle.load(f)
                    except EOFError:
                        break
                    part.insert(*entry)
            os.remove(path)
            if part.files:
                part._spill()
                todo += part.files.values()
            else:
                yield from part.trie.items()
        self.folder.cleanup()


_ENTRY = pa.schema([("n_bytes", pa.int64()), ("h", pa.int64()), ("body", pa.binary()), ("neg_chars", pa.int64()),
                    ("doc_id", pa.int64()), ("members", pa.int64())])
_ENTRY_DDL = "n_bytes BIGINT, h BIGINT, body BINARY, neg_chars BIGINT, doc_id BIGINT, members BIGINT"
_NO_ID = (1 << 63) - 1  # a null doc_id ranks last


def _collapse(df: DataFrame, budget: int) -> DataFrame:
    """Insert a partition's texts into tries; one row per distinct text of the partition.

    The trie holds the full strings; the hash, which only deals them out, lies beside.
    """
    def run(batches):
        drop_worker_cache()
        trie = SpillingTrie(budget)
        for rows in slices(batches):
            cols = [rows.column(n).to_pylist() for n in ("h", "body", "neg_chars", "doc_id", "members")]
            for h, body, chars, doc, members in zip(*cols):
                trie.insert(body, (chars, doc, members, h))
        out: list[tuple] = []
        size = 0
        for key, (chars, doc, members, h) in trie.items():
            out.append((len(key), h, key, chars, doc, members))
            size += len(key)
            if size > 1 << 24:
                yield _entries(out)
                out, size = [], 0
        if out:
            yield _entries(out)
    return df.mapInArrow(run, _ENTRY_DDL)


def _entries(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ENTRY)], schema=_ENTRY)


def normalised(col: str = "text") -> str:
    """SQL of the text without blanks (space and \\t to \\r); null counts as empty."""
    return f"translate(coalesce({col}, ''), ' \\t\\n\\u000B\\u000C\\r', '')"


def text_classes(docs: DataFrame, budget: int = 96 << 20) -> DataFrame:
    """One row per distinct normalised text of ``docs`` (doc_id, text).

    Returns n_bytes, h, text_sha256, keep_id, group_size.  The owner is the
    member with the most code points in its original text, then the smallest
    doc_id.  Tries on the map side collapse the copies of each input
    partition first, so a frequent text reaches its task once per partition.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.expr(f"{normalised()} AS norm"),
        F.expr("-cast(char_length(coalesce(text, '')) AS bigint)").alias("neg_chars"),
        F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc_id"), F.lit(1).cast("bigint").alias("members"))
    entries = rows.select(F.xxhash64("norm").alias("h"), F.expr("cast(norm AS binary)").alias("body"),
                          "neg_chars", "doc_id", "members")
    local = _collapse(entries, budget)
    dealt = local.repartition(shuffle_partitions(spark), "n_bytes", "h")
    return _collapse(dealt, budget).select(
        "n_bytes", "h", F.sha2("body", 256).alias("text_sha256"),
        F.expr(f"nullif(doc_id, {_NO_ID}L)").alias("keep_id"), F.col("members").alias("group_size"))


_CLASS = ["n_bytes", "h", "text_sha256"]


def _with_class(docs: DataFrame, *cols) -> DataFrame:
    """``cols`` of ``docs`` with the columns that name a text's class."""
    return docs.select(*cols, F.expr(f"{normalised()} AS norm")).select(
        *[c for c in cols], F.expr("cast(octet_length(norm) AS bigint)").alias("n_bytes"),
        F.xxhash64("norm").alias("h"), F.sha2("norm", 256).alias("text_sha256"))


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts are empty and equal to blank ones.  Of rows that repeat the
    owner's doc_id with an equal text all are kept: they are the same document.
    """
    return (_with_class(docs, "doc_id").join(text_classes(docs), _CLASS)
            .select("doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"), "text_sha256"))


def keep_owners(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any other columns) that own their text, unchanged."""
    rows = _with_class(docs.select("doc_id", "text", F.struct("*").alias("row")), "doc_id", "row")
    owners = text_classes(docs).select(*_CLASS, F.col("keep_id"))
    same = [rows[c] == owners[c] for c in _CLASS] + [rows.doc_id.eqNullSafe(owners.keep_id)]
    return rows.join(owners, same, "left_semi").select("row.*")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the document kept for its text."""
    return exact_duplicates(documents(spark, sf_dir))


OP3_SQL = r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id)
"""
