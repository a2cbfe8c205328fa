"""Vector best-fit packing of documents into sequences (operator 4)."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from wardflow.llm.common import documents, map_rows
from wardflow.llm.tokens import ID, encoder

PIECE_DDL = "doc_id BIGINT, piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT"


@dataclass(frozen=True)
class Capacity:
    """What one sequence can hold.

    ``attention`` bounds the sum of squared piece lengths (the cost of
    attention within pieces).  ``documents`` and ``attention`` default to values
    that tokens alone already guarantee.
    """
    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    # weights of the three residuals, each relative to its capacity
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3)

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.attention], float)


def pieces(docs: DataFrame, vocab: str, end_id: int, size: int) -> DataFrame:
    """Token pieces of each document (doc_id, text).

    A document has its ids and ``end_id``; null text counts as empty.  Only a
    document of more than ``size`` ids is cut: all its pieces have ``size``
    ids but the first, which holds the rest.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                        ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def make():
        enc = encoder(vocab)

        def step(rows: pa.RecordBatch) -> pa.RecordBatch:
            ids, at = enc.encode(rows.column(1))
            out = []
            for i, doc in enumerate(rows.column(0).to_pylist()):
                one = np.append(ids[at[i]:at[i + 1]], ID.type(end_id))
                cuts = np.r_[0, np.arange(len(one) % size or size, len(one) + 1, size)]
                for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
                    out.append((doc, k, a, b - a, zlib.crc32(one[a:b].tobytes())))
            cols = list(zip(*out)) or [[]] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)
        return step
    return map_rows(docs.select("doc_id", "text"), make, PIECE_DDL)


def best_fit(lengths: np.ndarray, cap: Capacity, score: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; pieces are taken from the longest to the shortest.

    Of the open sequences with room under every capacity, a piece goes to the
    one with the smallest weighted norm of what is left over after it
    (``norm``), or with the largest weighted dot product of its demand and the
    room there is (``dot``).  A piece that fits nowhere opens a sequence; one
    that breaks a capacity by itself has a sequence of its own.
    """
    n = len(lengths)
    limit, weights = cap.vector(), np.array(cap.weights)
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    room = np.empty((3, n))  # residual token, document and attention capacity of the open sequences
    used = np.zeros(n, np.int64)
    name = np.zeros(n, np.int64)
    n_open = n_bins = 0
    shortest = lengths.min(initial=1)
    for i in order:
        demand = np.array([lengths[i], 1.0, float(lengths[i]) ** 2])
        left = room[:, :n_open] - demand[:, None]
        fits = np.flatnonzero((left >= 0).all(axis=0))
        if len(fits):
            rest = left[:, fits] / limit[:, None]
            if score == "norm":
                k = fits[np.argmin(weights @ (rest * rest))]
            else:
                k = fits[np.argmax((weights * demand / limit) @ (rest + (demand / limit)[:, None]))]
            room[:, k] = left[:, k]
        else:
            k = n_open
            room[:, k] = limit - demand
            name[k], used[k] = n_bins, 0
            n_bins += 1
            n_open += 1
        bins[i], offsets[i] = name[k], used[k]
        used[k] += lengths[i]
        if room[0, k] < shortest or room[1, k] < 1 or room[2, k] < 1:  # closed: the last open one takes its place
            n_open -= 1
            room[:, k], name[k], used[k] = room[:, n_open], name[n_open], used[n_open]
    return bins, offsets


def pack(parts: DataFrame, n_shards: int, cap: Capacity = Capacity(), score: str = "norm") -> DataFrame:
    """Pack pieces (doc_id, piece, start, length, ids_crc32) into sequences.

    Pieces are dealt to shards by a hash of their whole row, so that every
    shard has a like mix of lengths whatever ids are frequent; each shard is
    packed by itself and leaves at most a few sequences part empty.  Sequence
    ids are unique over all shards.  Repeated rows are packed once each.
    """
    shard = F.pmod(F.xxhash64("doc_id", "piece", "start", "length", "ids_crc32"), F.lit(n_shards))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        bins, offsets = best_fit(table.column("length").to_numpy(), cap, score)
        base = table.column("shard")[0].as_py() << 32
        return (table.drop_columns(["shard"]).append_column("sequence_id", pa.array(bins + base))
                .append_column("offset", pa.array(offsets)))
    keyed = parts.select(*[c.strip().split()[0] for c in PIECE_DDL.split(",")], shard.alias("shard"))
    return keyed.groupBy("shard").applyInArrow(run, PIECE_DDL + ", sequence_id BIGINT, offset BIGINT")


def pack_documents(docs: DataFrame, vocab: str, end_id: int = 0, cap: Capacity = Capacity(),
                   docs_per_shard: int = 8192) -> DataFrame:
    """Encode, cut and pack all documents; one row per piece."""
    n_shards = max(1, -(-docs.count() // docs_per_shard))
    return pack(pieces(docs, vocab, end_id, cap.tokens), n_shards, cap)


def op4_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of at most 2048 tokens: one row per piece."""
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
