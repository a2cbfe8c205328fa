"""Compression-band quality rules (operator 7).

Text that repeats itself compresses too well, noise too badly.  The zstandard
ratio of a whole document, and of its fixed chunks, must lie in a band that
depends on the length of what is compressed.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from wardflow.llm.common import BLANKS, documents, drop_worker_cache, map_rows

SYMBOLS = "#*$%&|<>"
RULE_DDL = ("doc_id BIGINT, n_words BIGINT, word_chars BIGINT, n_symbols BIGINT, n_dup_lines BIGINT, "
            "n_repeat_words BIGINT, base_failed BOOLEAN, ratio DOUBLE, worst_chunk DOUBLE, band_failed BOOLEAN, "
            "kept BOOLEAN")


@dataclass(frozen=True)
class Bands:
    """Limits of the ratio (bytes before / after) by length in bytes, linear in log length between the points.

    The points are fixed values that leave a margin around prose labelled as
    good; a document fails if its own ratio leaves the band, or if more than
    ``chunk_share`` of its chunks or ``chunk_run`` in succession leave theirs.
    The ratio of clean prose rises with length until the compressor's window
    (2 MB at level 3) is full, so the points go beyond that; from the last one
    on the limits are flat.
    """
    length: tuple[float, ...] = (32, 64, 128, 256, 512, 1024, 2048, 4096, 8192, 16384,
                                 1 << 15, 1 << 16, 1 << 17, 1 << 18, 1 << 19, 1 << 20, 1 << 21, 1 << 22)
    low: tuple[float, ...] = (0.3, 0.5, 0.75, 1.0, 1.15, 1.3, 1.45, 1.6, 1.65, 1.7) + (1.7,) * 8
    high: tuple[float, ...] = (1.6, 1.7, 1.7, 1.8, 1.95, 2.12, 2.22, 2.36, 2.46, 2.56,
                               2.68, 2.78, 2.86, 2.94, 3.04, 3.12, 3.18, 3.22)
    chunk: int = 4096
    chunk_share: float = 0.25
    chunk_run: int = 2
    level: int = 3

    def outside(self, n: int, ratio: float) -> bool:
        x = np.log2(max(n, 1))
        return not (np.interp(x, np.log2(self.length), self.low) <= ratio
                    <= np.interp(x, np.log2(self.length), self.high))


def repeat_words(words: list[bytes], width: int = 5) -> int:
    """Words covered by windows of ``width`` words that occur at least twice in the list.

    Windows are compared exactly: each doubling or extension of the compared
    width replaces sequences by their rank among the document's distinct ones.
    """
    n = len(words)
    if n <= width:
        return 0
    number: dict[bytes, int] = {}
    one = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    rank, k = one, 1
    while k < width:
        step = min(k, width - k)
        head, tail = (rank, rank[k:]) if step == k else (rank, _ranks_of(one, step)[k:])
        m = n - k - step + 1
        rank = np.unique(head[:m] * (int(tail.max()) + 1) + tail[:m], return_inverse=True)[1]
        k += step
    twice = np.flatnonzero(np.bincount(rank)[rank] > 1)
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + width, -1)
    return int((np.cumsum(cover) > 0).sum())


def _ranks_of(one: np.ndarray, width: int) -> np.ndarray:
    rank = one
    for k in range(1, width):
        m = len(one) - k
        rank = np.unique(rank[:m] * (int(one.max()) + 1) + one[k:], return_inverse=True)[1]
    return rank


def _judge(bands: Bands):
    """The rules as a function of one row's doc_id and text."""
    squeeze = zstandard.ZstdCompressor(level=bands.level).compress

    def ratio(raw: bytes) -> float:
        return len(raw) / len(squeeze(raw))

    def judge(doc, text):
        text = text or ""
        raw = text.encode()
        words = raw.split()
        n = len(words)
        lines = [x for x in text.split("\n") if x.strip(BLANKS)]
        repeated = repeat_words(words)
        base = n < 10 or 100 * repeated > 20 * n
        whole = ratio(raw) if raw else 0.0
        chunks = [raw[i:i + bands.chunk] for i in range(0, len(raw), bands.chunk)]
        ratios = [ratio(c) for c in chunks]
        out = [bands.outside(len(c), r) for c, r in zip(chunks, ratios)]
        run = max((len(list(g)) for bad, g in groupby(out) if bad), default=0)
        band = (not raw or bands.outside(len(raw), whole) or sum(out) > bands.chunk_share * len(chunks)
                or run >= bands.chunk_run)
        return (doc, n, len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)),
                len(lines) - len(set(lines)), repeated, base, whole, max(ratios, default=0.0), band,
                not base and not band)
    return judge


def apply_rules(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """Measure every whole text of ``docs`` (doc_id, text) and judge it: one row per row.

    A null or empty text has zero words and fails the base rules.  The base
    rules come first; the bands are measured for every document and decide
    where the base rules pass.  Other columns are not read.
    """
    names = [c.strip().split()[0] for c in RULE_DDL.split(",")]

    def make():
        drop_worker_cache()
        judge = _judge(bands)

        def step(rows: pa.RecordBatch) -> pa.RecordBatch:
            out = [judge(d, t) for d, t in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _TYPES)], names=names)
        return step
    return map_rows(docs.select("doc_id", "text"), make, RULE_DDL)


def passing(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The rows of ``docs`` (text and any other columns) that ``apply_rules`` keeps, unchanged."""
    at = docs.columns.index("text")

    def make():
        drop_worker_cache()
        judge = _judge(bands)
        return lambda rows: rows.filter(pa.array([judge(None, t)[-1] for t in rows.column(at).to_pylist()], pa.bool_()))
    return map_rows(docs, make, docs.schema)


_TYPES = [pa.int64()] * 6 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_(), pa.bool_()]


def op7_compression_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures, compression ratios and verdict of every document."""
    return apply_rules(documents(spark, sf_dir))
