"""Importance resampling with hashed n-gram models (operator 2)."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardflow.llm.common import Scratch, documents, map_rows, slices, word_hashes
from wardflow.sources.tables import read_table

_WORD = re.compile(r"\w+|[^\w\s]+")


def ngram_buckets(text: str, n_buckets: int) -> np.ndarray:
    """Buckets of the words and adjacent word pairs of a lower-cased text."""
    one = word_hashes(_WORD.findall(text.lower()))
    two = one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:]
    two ^= two >> np.uint64(29)
    return (np.concatenate([one, two * np.uint64(0xBF58476D1CE4E5B9)]) >> np.uint64(20)) % np.uint64(n_buckets)


def fit_log_ratios(docs: DataFrame, n_buckets: int, smoothing: float = 1.0) -> np.ndarray:
    """log(target / raw) of each bucket's smoothed probability.

    ``docs`` has text and target (boolean).  Both models count the n-grams of
    all rows they describe: raw of every row, target of the rows marked so.
    Tasks count locally; only bucket totals come to the driver.
    """
    def count(batches):
        target, raw = np.zeros(n_buckets, np.int64), np.zeros(n_buckets, np.int64)
        for rows in slices(batches):
            for text, good in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                got = np.bincount(ngram_buckets(text or "", n_buckets).astype(np.int64), minlength=n_buckets)
                raw += got
                if good:
                    target += got
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(target[at]), pa.array(raw[at])],
                                         names=["bucket", "target", "raw"])
    counts = (docs.select("text", "target").mapInArrow(count, "bucket BIGINT, target BIGINT, raw BIGINT")
              .groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw"))
              .toPandas())  # at most n_buckets rows
    model = np.full((2, n_buckets), smoothing)
    model[0, counts.bucket] += counts.target
    model[1, counts.bucket] += counts.raw
    p = model / model.sum(axis=1, keepdims=True)
    return np.log(p[0] / p[1])


def score(docs: DataFrame, log_ratios: np.ndarray) -> DataFrame:
    """doc_id, n_ngrams and log_weight (sum of log ratios) of every row; empty texts weigh 0."""
    def make():
        def step(rows: pa.RecordBatch) -> pa.RecordBatch:
            got = [ngram_buckets(t or "", len(log_ratios)) for t in rows.column(1).to_pylist()]
            return pa.RecordBatch.from_pydict(
                {"doc_id": rows.column(0), "n_ngrams": [len(b) for b in got],
                 "log_weight": [float(log_ratios[b.astype(np.int64)].sum()) for b in got]},
                schema=pa.schema([("doc_id", pa.int64()), ("n_ngrams", pa.int64()), ("log_weight", pa.float64())]))
        return step
    return map_rows(docs.select("doc_id", "text"), make, "doc_id BIGINT, n_ngrams BIGINT, log_weight DOUBLE")


def gumbel(seed: int) -> Column:
    """Standard Gumbel noise fixed by doc_id and seed."""
    u = (F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return -F.log(-F.log(u))


def kth_largest(scored: DataFrame, k: int) -> tuple[float, int] | None:
    """(key, doc_id) of the k-th row by key descending, then doc_id; null ids last.

    The rank is located in 4,096 equal steps of the value range, then inside
    that step, and so on until few rows are left; nothing is sorted as a whole.
    """
    def narrow(rows: DataFrame, col: str, k: int, down: bool):
        while True:
            lo, hi, n = rows.agg(F.min(col), F.max(col), F.count(col)).first()
            if n <= 10_000 or lo == hi:
                return rows, k
            width = (hi - lo) / 4096
            step = F.least(F.floor((F.col(col) - lo) / width), F.lit(4095))
            counts = rows.groupBy(step.alias("step")).count().toPandas().sort_values("step", ascending=not down)
            passed = counts["count"].cumsum()
            at = int((passed < k).sum())
            k -= int(passed.iloc[at - 1]) if at else 0
            rows = rows.where(step == int(counts.step.iloc[at]))
    if k <= 0:
        return None
    rows = scored.select("key", F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc_id"))
    rows, k = narrow(rows, "key", k, True)
    if rows.agg(F.min("key") == F.max("key")).first()[0]:
        rows, k = narrow(rows, "doc_id", k, False)
        if rows.agg(F.min("doc_id") == F.max("doc_id")).first()[0]:
            return tuple(rows.first())
    return tuple(rows.orderBy(F.desc("key"), "doc_id").limit(k).agg(
        F.max_by(F.struct("key", "doc_id"), F.struct(-F.col("key"), "doc_id"))).first()[0])


def resample(docs: DataFrame, labels: DataFrame, share: float, n_buckets: int = 1 << 16, seed: int = 7) -> DataFrame:
    """Draw a ``share`` of the rows without replacement by Gumbel top-k on their importance.

    ``labels`` (doc_id, quality) marks the target text by quality 1; a null or missing label is
    not target.  Returns every row: doc_id, n_ngrams, log_weight, key (log_weight plus Gumbel noise)
    and kept.  Equal keys are drawn by doc_id; repeated rows share a key and are drawn alike.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "resample")
    good = labels.where("quality = 1").select("doc_id").distinct().withColumn("target", F.lit(True))
    # one plan at every size: labels grow with the documents and are never broadcast
    marked = docs.select("doc_id", "text").join(good.hint("merge"), "doc_id", "left")
    ratios = fit_log_ratios(marked, n_buckets)
    scored = scratch.save(score(docs, ratios).withColumn("key", F.col("log_weight") + gumbel(seed)), "scored")
    cut = kth_largest(scored, round(share * scored.count()))
    kept = (F.lit(False) if cut is None else
            (F.col("key") > cut[0]) | ((F.col("key") == cut[0]) & (F.coalesce("doc_id", F.lit((1 << 63) - 1)) <= cut[1])))
    return scored.withColumn("kept", kept)


def op2_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four fifths of all documents drawn by importance for the text labelled good."""
    return resample(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"), share=0.8)
