"""Repeated passages by FM-indexes over content-dealt shards (operator 5).

Equal windows of words have the same smallest word-gram (anchor), so segments
of consecutive windows with one anchor are dealt by it.  Anchors that occur once
need no index.  A shard's segments form the text of a compressed FM-index, and the
same segments are streamed through backward search: a window that is matched in full and has an
earlier position in its suffix interval is a repeat.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import chain, count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from wardflow.llm.common import Scratch, documents, drop_worker_cache, map_rows, shuffle_partitions, slices, word_hashes
from wardflow.llm.fm_index import FMIndex

GRAM = 8  # words of an anchor
CHUNK_ROWS = 24_000  # segments of one index
HOT_ROWS = 20_000  # anchors with more segments are dealt window by window
GROUP_WORDS = 100_000  # words whose windows are found together
_MULT = np.uint64(0x9E3779B97F4A7C15)


def _gram_hashes(one: np.ndarray, k: int) -> np.ndarray:
    n = len(one) - k + 1
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = (h ^ (h >> np.uint64(31))) * _MULT + one[i:n + i]
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _first_minima(g: np.ndarray, span: int) -> np.ndarray:
    """Where the first of the smallest values of each window of ``span`` values is."""
    low, at, wide = g, np.arange(len(g)), 1
    while wide < span:
        by = min(wide, span - wide)  # two windows that overlap or touch make a wider one
        right = low[by:] < low[:-by]
        at = np.where(right, at[by:], at[:-by])
        low = np.minimum(low[by:], low[:-by])
        wide += by
    return at


def segments_of(texts: list[list[bytes]], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, text (by number), first window and number of windows of each run of a text's windows with one anchor."""
    sizes = np.array([len(words) for words in texts], np.int64)
    if sizes.max(initial=0) >= 1 << 27:
        raise ValueError("a text of 134,217,728 words or more: windows are numbered in 27 bits")
    none = (np.zeros(0, np.int64),) * 4
    if sizes.max(initial=0) < width:
        return none
    gram = min(GRAM, width)
    g = _gram_hashes(word_hashes(list(chain.from_iterable(texts))), gram)
    at = _first_minima(g, width - gram + 1)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(texts)), sizes)[:len(at)]
    start = np.flatnonzero(np.arange(len(at)) + width <= ends[owner])  # windows that lie in one text
    at, owner = at[start], owner[start]
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    text = owner[first]
    return g[at[first]].view(np.int64), text, start[first] - (ends - sizes)[text], np.diff(np.r_[first, len(at)])


def _segments(rows: DataFrame, width: int) -> DataFrame:
    """(key, doc, at) of every segment; ``at`` packs text hash, first window and number of windows."""
    schema = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("at", pa.int64())])

    def make():
        drop_worker_cache()  # the words of an earlier stage

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            docs, hashes = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(2))
            out = [(np.zeros(0, np.int64),) * 3]
            held: list[list[bytes]] = []
            begin = words = 0

            def judge():
                key, text, s, c = segments_of(held, width)
                text += begin
                out.append((key, docs[text], (hashes[text] << 32) | (s << 5) | c))
            for i, text in enumerate(batch.column(2).to_pylist()):
                held.append((text or "").encode().split())
                words += len(held[-1])
                if words >= GROUP_WORDS:
                    judge()
                    held, begin, words = [], i + 1, 0
            if held:
                judge()
            keys, docs, ats = zip(*out)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, docs, ats)], schema=schema)
        return step
    return map_rows(rows, make, "key BIGINT, doc BIGINT, at BIGINT")


_PART = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("th", pa.int32()), ("s", pa.int32()), ("c", pa.int32()),
                   ("words", pa.binary())])
_PART_DDL = "key BIGINT, doc BIGINT, th INT, s INT, c INT, words BINARY"


def _with_words(rows: DataFrame, width: int) -> DataFrame:
    """Segments to be judged, with their words; of equal ones of a slice only the first by position.

    ``rows`` has doc, th, text and shared (array of key, at, hot).  The later ones of
    equal segments come out with null words: all their windows are repeats.
    """
    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            best: dict[tuple[int, bytes], tuple] = {}
            out = []
            segs = batch.column(3)
            flat = [segs.flatten().field(i).to_numpy(zero_copy_only=False) for i in range(3)]
            keys, hots = flat[0].tolist(), flat[2].tolist()
            firsts, counts = ((flat[1] & 0xFFFFFFFF) >> 5).tolist(), (flat[1] & 31).tolist()
            ends = np.cumsum(segs.value_lengths().to_numpy(zero_copy_only=False)).tolist()
            for doc, th, text, begin, end in zip(*(batch.column(i).to_pylist() for i in range(3)), [0, *ends], ends):
                words = (text or "").encode().split()
                for j in range(begin, end):
                    s, c, hot = firsts[j], counts[j], hots[j]
                    if hot:
                        todo = [(i, 1) for i in range(s, s + c)]
                    else:
                        todo = [(s, c)]
                    for i, n in todo:
                        body = b" ".join(words[i:i + n + width - 1])
                        key = xxhash.xxh3_64_intdigest(body) - (1 << 63) if hot else keys[j]
                        row = (doc, th, i, n)
                        lead = best.setdefault((key, body), row)
                        if lead is row:
                            continue
                        if row < lead:
                            best[key, body] = row
                            row, lead = lead, row
                        if row[:3] != lead[:3]:
                            out.append((key, *row, None))
            out += [(key, *row, body) for (key, body), row in best.items()]
            cols = list(zip(*out)) or [[]] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _PART)], schema=_PART)
        return step
    return map_rows(rows, make, _PART_DDL)


def judge_chunk(rows: list[tuple[int, int, int, int, int, bytes]], width: int) -> list[tuple[int, int, int, int]]:
    """Repeated windows (doc, th, first, number) among segments (key, doc, th, s, c, words).

    Equal segments are one: the first by position stays, the others are repeats as a whole.
    The rest are the index and the queries.
    """
    out = []
    leaders: dict[bytes, tuple[int, int, int, int]] = {}  # equal words have the same key
    for _, doc, th, s, c, body in rows:
        pos = (doc, th, s, c)
        lead = leaders.setdefault(body, pos)
        if lead is not pos:
            if pos < lead:
                leaders[body] = pos
                pos, lead = lead, pos
            if lead[:3] != pos[:3]:
                out.append(pos)
    ordered = sorted((pos, body) for body, pos in leaders.items())
    number: dict[bytes, int] = defaultdict(count(1).__next__)
    text: list[int] = []
    ends = []
    for _, body in ordered:
        text.extend(map(number.__getitem__, body.split(b" ")))
        text.append(0)
        ends.append(len(text))
    if not ordered:
        return out
    symbols = np.array(text, np.int64)
    windows = np.array([pos[3] for pos, _ in ordered])
    own = np.repeat(np.arange(len(ordered)), windows)
    first_of, first_at = np.cumsum(windows) - windows, np.array([0, *ends[:-1]], np.int64)
    nth = np.arange(len(own)) - first_of[own]
    at = first_at[own] + nth
    index = FMIndex(symbols, len(number) + 1, width)
    _, full, lo, hi = index.matching_windows(symbols, at, width)
    repeat = full[index.first_positions(lo, hi) < at[full]]
    for k, i in zip(own[repeat].tolist(), nth[repeat].tolist()):
        doc, th, s, _ = ordered[k][0]
        out.append((doc, th, s + i, 1))
    return out


def _repeats(parts: DataFrame, width: int) -> DataFrame:
    """Index and query each partition's segments, a bounded number of whole keys at a time."""
    schema = pa.schema([("doc", pa.int64()), ("th", pa.int32()), ("s", pa.int32()), ("c", pa.int32())])

    def run(batches):
        drop_worker_cache()
        held: list[tuple] = []

        def judged():
            cols = list(zip(*judge_chunk(held, width))) or [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)
        for batch in slices(batches):
            for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if len(held) >= CHUNK_ROWS and held[-1][0] != row[0]:
                    yield judged()
                    held.clear()
                held.append(row)
        if held:
            yield judged()
    dealt = parts.repartition(shuffle_partitions(parts.sparkSession), "key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "doc BIGINT, th INT, s INT, c INT")


def _identified(docs: DataFrame) -> DataFrame:
    """A row's place in the order of documents: doc_id (null first), then a hash of its text."""
    return docs.withColumn("doc", F.coalesce("doc_id", F.lit(-(1 << 63)))).withColumn(
        "th", F.expr("cast(xxhash64(text) & 2147483647 AS int)"))


def repeated_spans(docs: DataFrame, width: int = 20) -> DataFrame:
    """Words to remove, per document: (doc, th, spans), spans being an array of (s, e) in words.

    A word is removed if a window of ``width`` words over it also starts earlier:
    in a smaller doc_id or before in the same document.  Rows of one doc_id with different texts
    are ordered by a hash of the text; rows that repeat doc_id and text are one document.
    """
    if width > 31:
        raise ValueError("width is at most 31 words")
    spark = docs.sparkSession
    scratch = Scratch(spark, "substring")
    rows = _identified(docs.select("doc_id", "text")).select("doc", "th", "text")
    segs = scratch.save(_segments(rows, width), "segments")
    often = segs.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = segs.join(often, "key").groupBy("doc", F.expr("cast(shiftright(at, 32) AS int)").alias("th")).agg(
        F.collect_set(F.struct("key", "at", F.expr(f"n > {HOT_ROWS}").alias("hot"))).alias("shared"))  # one document's own
    shared = scratch.save(shared, "shared")
    scratch.drop("segments")
    parts = scratch.save(_with_words(rows.join(shared, ["doc", "th"]).select("doc", "th", "text", "shared"), width), "parts")
    scratch.drop("shared")
    found = _repeats(parts.where("words IS NOT NULL"), width)
    later = parts.where("words IS NULL").select("doc", "th", "s", "c")
    repeats = scratch.save(found.union(later), "repeats")  # no words of segments lie on disk while texts are shuffled again
    scratch.drop("parts")
    return repeats.groupBy("doc", "th").agg(
        F.collect_list(F.struct("s", F.expr(f"s + c + {width - 1}").alias("e"))).alias("spans"))


def remove_repeats(docs: DataFrame, width: int = 20, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, ...) without its repeated passages.

    Returns row (struct of the ``carry`` columns as they are), n_words, n_removed, kept_text (words
    left, joined by one space) and spans (merged removed word ranges).  Null texts have no words.
    """
    spans = repeated_spans(docs, width)
    rows = _identified(docs.select("doc_id", "text", F.struct(*carry).alias("row")))
    joined = rows.join(spans, ["doc", "th"], "left").select("row", "text", "spans")
    span_type = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))

    def cut(text: str | None, spans: list[dict] | None):
        words = (text or "").encode().split()
        merged: list[dict] = []
        for x in sorted(spans or (), key=lambda x: x["s"]):
            if merged and x["s"] <= merged[-1]["e"]:
                merged[-1]["e"] = max(merged[-1]["e"], x["e"])
            else:
                merged.append(dict(x))
        left, at = [], 0
        for x in merged:
            left += words[at:x["s"]]
            at = x["e"]
        left += words[at:]
        return len(words), len(words) - len(left), b" ".join(left).decode(), merged

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            got = [cut(t, x) for t, x in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            n, removed, kept, spans = zip(*got)
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()),
                 pa.array(spans, span_type)], names=["row", "n_words", "n_removed", "kept_text", "spans"])
        return step
    row = joined.schema["row"].dataType.simpleString()
    return map_rows(joined, make, f"row {row}, n_words BIGINT, n_removed BIGINT, kept_text STRING, "
                                  "spans ARRAY<STRUCT<s: INT, e: INT>>")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the windows of 20 words that start earlier."""
    return remove_repeats(documents(spark, sf_dir)).select(
        "row.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
