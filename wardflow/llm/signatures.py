"""Ranked lexical search with bit-sliced Bloom signatures (operator 13).

Documents of like length share a block.  A block's signature is a bit matrix:
a row (slice) for each Bloom position, a column for each document.  The slices of a term, and-ed,
overestimate where it occurs; terms are entered once per level of their count,
so weighted sums of slices bound every document's score from above.  Documents whose bound
reaches the best scores known are rescored exactly from the block's term counts.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from wardflow.llm.common import Scratch, documents, drop_worker_cache, map_rows, slices
from wardflow.llm.merkle import number_rows
from wardflow.session import owned_dir
from wardflow.sources.tables import read_table

# Bytes of a term are ASCII letters and digits and everything beyond ASCII; A-Z become a-z.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
PROBES = 4          # Bloom positions of a key
BITS_PER_KEY = 8    # of the longest document of a length class
BLOCK_DOCS = 512
BLOCK_KEYS = 1 << 18
MAX_VOCAB = 400_000  # terms that a task remembers before its blocks are closed
MAX_CELLS = 1 << 21  # (query term, document) cells handled at a time
# Counts from which a term is entered once more: 1, 2, 3, 4, 6, 8, 12, 16, ...
LEVELS = np.array([1, 2, 3, *[x << k for k in range(29) for x in (4, 6)]], np.int64)


def terms(text: str | None) -> list[bytes]:
    """All terms of a whole text, in order."""
    return (text or "").encode().translate(_TERMS).split()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def positions(hashes: np.ndarray, level: np.ndarray | int, n_bits: int) -> np.ndarray:
    """The Bloom positions of (term hash, level) keys: one row of ``PROBES`` for each."""
    key = _mix(hashes + np.asarray(level, np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    a, b = key >> np.uint64(32), (key & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    return ((a[:, None] + b[:, None] * np.arange(PROBES, dtype=np.uint64)) & np.uint64(n_bits - 1)).astype(np.int64)


def hash_terms(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)


# ---- index --------------------------------------------------------------------

BLOCK_DDL = ("n_docs BIGINT, n_terms BIGINT, n_bits BIGINT, doc_ids ARRAY<BIGINT>, lengths ARRAY<BIGINT>, slices BINARY, "
             "vocab ARRAY<STRING>, df ARRAY<BIGINT>, ends ARRAY<BIGINT>, ids BINARY, tf BINARY")
_BLOCK = pa.schema([("n_docs", pa.int64()), ("n_terms", pa.int64()), ("n_bits", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                    ("lengths", pa.list_(pa.int64())), ("slices", pa.binary()), ("vocab", pa.list_(pa.string())),
                    ("df", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("ids", pa.binary()), ("tf", pa.binary())])


class BlockBuilder:
    """Blocks of the documents of one task: one open block for each length class."""

    def __init__(self):
        self.vocab: dict[bytes, int] = defaultdict(count().__next__)
        self.open: dict[int, list] = defaultdict(list)
        self.keys: dict[int, int] = defaultdict(int)

    def add(self, doc_id: int | None, text: str | None):
        """Enter a document; gives the block that it completes, or None.  A text without terms is in no block."""
        vocab = self.vocab
        found = [vocab[w] for w in terms(text)]
        if not found:
            return None
        ids, tf = np.unique(np.array(found, np.int64), return_counts=True)
        n_keys = int(np.searchsorted(LEVELS, tf, side="right").sum())
        c = max(6, (n_keys - 1).bit_length())
        self.open[c].append((doc_id, len(found), ids, tf))
        self.keys[c] += n_keys
        return self.close(c) if len(self.open[c]) >= BLOCK_DOCS or self.keys[c] >= BLOCK_KEYS else None

    def close(self, c: int) -> dict:
        docs, self.keys[c] = self.open.pop(c), 0
        doc_ids, lengths, ids, tf = zip(*docs)
        names = list(self.vocab)  # in the order of their numbers
        size = np.array([len(x) for x in ids])
        which, local = np.unique(np.concatenate(ids), return_inverse=True)
        tf = np.concatenate(tf)
        vocab = [names[i] for i in which.tolist()]
        n_bits = BITS_PER_KEY << c
        matrix = np.zeros((n_bits, -(-len(docs) // 8) * 8), bool)
        hashes, doc = hash_terms(vocab)[local], np.repeat(np.arange(len(docs)), size)
        for level, least in enumerate(LEVELS):
            entered = tf >= least
            if not entered.any():
                break
            at = positions(hashes[entered], level, n_bits)
            matrix[at, doc[entered][:, None]] = True
        return {"n_docs": len(docs), "n_terms": sum(lengths), "n_bits": n_bits, "doc_ids": list(doc_ids), "lengths": list(lengths),
                "slices": np.packbits(matrix, axis=1).tobytes(), "vocab": [w.decode() for w in vocab],
                "df": np.bincount(local), "ends": np.cumsum(size), "ids": local.astype("<u4").tobytes(), "tf": tf.astype("<u4").tobytes()}

    def close_all(self):
        done = [self.close(c) for c in sorted(self.open)]
        self.vocab = defaultdict(count().__next__)
        return done


def _batch(block: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([block[f.name]], f.type) for f in _BLOCK], schema=_BLOCK)


def build_index(docs: DataFrame, path: str) -> DataFrame:
    """Write the blocks of ``docs`` (doc_id, text) as a Parquet table and read it.

    A task tokenises its whole texts and closes a block at 512 documents or 262,144 keys of one
    length class; nothing is shuffled.  Texts without terms (null, too) are in no block.  Repeated rows are documents
    of their own; a null doc_id is kept.
    """
    def run(batches):
        drop_worker_cache()
        builder = BlockBuilder()
        for rows in slices(batches, 256):
            for doc, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                if block := builder.add(doc, text):
                    yield _batch(block)
            if len(builder.vocab) > MAX_VOCAB:
                yield from map(_batch, builder.close_all())
        yield from map(_batch, builder.close_all())
    docs.select("doc_id", "text").mapInArrow(run, BLOCK_DDL).write.parquet(path)
    return docs.sparkSession.read.schema(BLOCK_DDL).parquet(path)


# ---- search -------------------------------------------------------------------

@dataclass(frozen=True)
class Slab:
    """Queries of one pass: distinct terms, and per query (named by its number) its terms and weights."""
    items: list[int]
    words: list[str]
    hashes: np.ndarray
    term: np.ndarray    # per entry: which word
    weight: np.ndarray  # per entry
    first: np.ndarray   # per item: its first entry


@dataclass(frozen=True)
class Collection:
    """Documents with a term, and all their terms with repeats."""
    docs: int
    terms: int

    def length_factor(self, lengths: np.ndarray) -> np.ndarray:
        if self.docs and int(lengths.max(initial=0)) > ((1 << 63) - 1) // (50 * self.docs):
            raise OverflowError("a document is too long for 64-bit scores")
        return 100 - 50 + (50 * lengths * self.docs) // self.terms


def saturation(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class Block:
    """A block opened for one slab of queries."""

    def __init__(self, row: pa.RecordBatch, collection: Collection):
        get = {n: row.column(n)[0] for n in row.schema.names}
        self.n = get["n_docs"].as_py()
        self.doc_ids = get["doc_ids"].as_py()
        self.lengths = np.array(get["lengths"].as_py(), np.int64)
        self.m = collection.length_factor(self.lengths)
        self.n_bits = get["n_bits"].as_py()
        self.bits = np.frombuffer(get["slices"].as_buffer(), np.uint8).reshape(self.n_bits, -1)
        self.vocab = get["vocab"].values
        self.ends = np.array(get["ends"].as_py(), np.int64)
        self.ids = np.frombuffer(get["ids"].as_buffer(), "<u4")
        self.tf = np.frombuffer(get["tf"].as_buffer(), "<u4")

    def most(self, hashes: np.ndarray) -> np.ndarray:
        """[term, document]: an upper bound of the term's saturated count, 0 where it can't occur."""
        at_most = np.zeros((len(hashes), self.n), np.int64)
        active, seen = np.arange(len(hashes)), None
        for level in range(len(LEVELS)):
            sliced = np.bitwise_and.reduce(self.bits[positions(hashes[active], level, self.n_bits)], axis=1)
            seen = sliced if seen is None else seen & sliced
            some = seen.any(axis=1)
            active, seen = active[some], seen[some]
            if not len(active):
                break
            upto = LEVELS[level + 1] - 1 if level + 1 < len(LEVELS) else np.int64(1 << 32)
            bound = saturation(np.minimum(upto, self.lengths), self.m)
            here = np.unpackbits(seen, axis=1, count=self.n).view(bool)
            at_most[active] = np.where(here, bound, at_most[active])
        return at_most

    def exact(self, words: pa.Array, docs: np.ndarray) -> np.ndarray:
        """[term, one of ``docs``]: the saturated counts."""
        known = pc.index_in(words, value_set=self.vocab).fill_null(-1).to_numpy(zero_copy_only=False)
        number = np.full(len(self.vocab) + 1, -1)
        number[known] = np.where(known < 0, -1, np.arange(len(known)))
        number[-1] = -1
        starts = np.r_[0, self.ends[:-1]]
        size = (self.ends - starts)[docs]
        at = np.repeat(starts[docs] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        term, doc = number[self.ids[at]], np.repeat(np.arange(len(docs)), size)
        hit = term >= 0
        out = np.zeros((len(words), len(docs)), np.int64)
        out[term[hit], doc[hit]] = saturation(self.tf[at[hit]].astype(np.int64), self.m[docs[doc[hit]]])
        return out


class Best:
    """The k best documents of every query of a slab so far: by score, then by smallest doc_id (null last)."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.found: list[list[tuple]] = [[] for _ in range(n_items)]
        self.least = np.ones(n_items, np.int64)  # a score below cannot enter

    def add(self, item: int, scores: list[int], docs: list) -> None:
        now = self.found[item]
        now += [(-s, d is None, d or 0) for s, d in zip(scores, docs)]
        now.sort()
        del now[self.k:]
        if len(now) == self.k:
            self.least[item] = -now[-1][0]


def _sums(per_term: np.ndarray, slab: Slab) -> np.ndarray:
    """[item, document]: weighted sums of the rows of each item's terms."""
    return np.add.reduceat(per_term[slab.term] * slab.weight[:, None], slab.first, axis=0)


def search_block(block: Block, slab: Slab, words: pa.Array, best: Best) -> int:
    """Rescore the documents of a block that their bounds don't exclude; returns how many (item, document) pairs."""
    rescored = 0
    width = max(1, MAX_CELLS // max(len(slab.term), len(slab.words)))
    bounds = np.empty((len(slab.items), block.n), np.int64)
    most = block.most(slab.hashes)
    for lo in range(0, block.n, width):
        bounds[:, lo:lo + width] = _sums(most[:, lo:lo + width], slab)
    # the documents with the highest bounds first: their scores exclude others
    strongest = np.argsort(-bounds.max(axis=0), kind="stable")
    for lo in range(0, block.n, min(width, 64)):
        docs = strongest[lo:lo + min(width, 64)]
        open_ = bounds[:, docs] >= best.least[:, None]
        keep = open_.any(axis=0)
        if not keep.any():
            continue
        docs, open_ = docs[keep], open_[:, keep]
        scores = _sums(block.exact(words, docs), slab)
        enter = open_ & (scores >= best.least[:, None])
        rescored += int(open_.sum())
        for item in np.flatnonzero(enter.any(axis=1)).tolist():
            at = np.flatnonzero(enter[item])
            best.add(item, scores[item, at].tolist(), [block.doc_ids[i] for i in docs[at].tolist()])
    return rescored


_HIT = pa.schema([("query", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _scan(index: DataFrame, slab: Slab, collection: Collection, k: int) -> DataFrame:
    """The k best documents of each task for each query of the slab: query, doc_id, score."""
    shared = index.sparkSession.sparkContext.broadcast(slab)  # bounded by the slab's entries

    def run(batches):
        drop_worker_cache()
        queries = shared.value
        best, words = Best(len(queries.items), k), pa.array(queries.words, pa.string())
        for row in slices(batches, 1):
            search_block(Block(row, collection), queries, words, best)
        rows = [(q, None if null else doc, -s) for q, got in zip(queries.items, best.found) for s, null, doc in got]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [[]] * 3, _HIT)], schema=_HIT)
    return index.select("n_docs", "n_bits", "doc_ids", "lengths", "slices", "vocab", "ends", "ids", "tf").mapInArrow(
        run, "query BIGINT, doc_id BIGINT, score BIGINT")


def query_terms(queries: DataFrame) -> DataFrame:
    """The distinct terms of each item of ``queries`` (item_id, text): item_id, term."""
    def make():
        def step(rows: pa.RecordBatch) -> pa.RecordBatch:
            pairs = [(i, w.decode()) for i, t in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()) for w in set(terms(t))]
            schema = pa.schema([("item_id", pa.int64()), ("term", pa.string())])
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*pairs)) or [[]] * 2, schema)], schema=schema)
        return step
    return map_rows(queries.select("item_id", "text"), make, "item_id BIGINT, term STRING").distinct()


def search(index: DataFrame, queries: DataFrame, k: int = 50, slab_entries: int = 1 << 14) -> DataFrame:
    """The ``k`` highest-scoring documents of every item of ``queries`` (item_id, text).

    Weights come from exact document counts of the whole index.  Queries go over the index in slabs of about
    ``slab_entries`` (item, term) entries each, so that what a task holds is bounded whatever the number of
    queries; every slab meets every block.  Each task returns its k best documents for each query, and these
    are ranked in two steps.  Rows of one item_id (null is one, too) are one query of all their terms.
    Returns item_id, rank (from 1), doc_id, score (above 0); equal scores rank by doc_id, null last.
    """
    spark = index.sparkSession
    scratch = Scratch(spark, "search")
    asked = scratch.save(query_terms(queries), "terms")
    total = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    collection = Collection(total[0] or 0, total[1] or 0)
    counts = index.select(F.explode(F.arrays_zip("vocab", "df")).alias("e")).select(F.col("e.vocab").alias("term"), F.col("e.df").alias("df"))
    wanted = counts.join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weighed = asked.join(wanted, "term").withColumn(
        "weight", F.expr(f"cast(floor(1000 * ln((2D * {collection.docs} + 2) / (2D * df + 1))) AS bigint)")).where("weight > 0")
    items = weighed.groupBy("item_id").agg(F.count("*").alias("n"))
    numbered = number_rows(items, [F.col("item_id").asc_nulls_first()], scratch, "items")
    # running number of entries, by range and within it; a slab ends where a multiple of slab_entries is passed
    per_range = numbered.groupBy("range").agg(F.sum("n").alias("all"))
    base = per_range.select("range", (F.sum("all").over(Window.orderBy("range")) - F.col("all")).alias("base"))
    inside = F.sum("n").over(Window.partitionBy("range").orderBy("at")) - F.col("n")
    slabbed = numbered.withColumn("inside", inside).join(F.broadcast(base), "range").withColumn(
        "slab", F.expr(f"cast((base + inside) div {int(slab_entries)} AS bigint)")).select("item_id", F.col("at").alias("query"), "slab")
    entries = scratch.save(weighed.alias("w").join(slabbed.alias("s"), F.expr("w.item_id <=> s.item_id")).select(
        "s.slab", "s.query", "w.item_id", "w.term", "w.weight"), "entries")
    hits = []
    for (slab,) in entries.select("slab").distinct().orderBy("slab").collect():  # one row per slab of queries
        rows = entries.where(F.col("slab") == slab).orderBy("query", "term").select("query", "term", "weight").collect()
        words = sorted({r.term for r in rows})
        number = {w: i for i, w in enumerate(words)}
        query = np.array([r.query for r in rows])
        first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
        hits.append(_scan(index, Slab(query[first].tolist(), words, hash_terms([w.encode() for w in words]),
                                      np.array([number[r.term] for r in rows]), np.array([r.weight for r in rows], np.int64), first),
                          collection, k))
    if not hits:
        return spark.createDataFrame([], "item_id BIGINT, rank INT, doc_id BIGINT, score BIGINT")
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    found = reduce(DataFrame.unionAll, hits).withColumn("part", F.expr("pmod(xxhash64(doc_id, score), 64)"))
    some = found.withColumn("r", F.row_number().over(Window.partitionBy("query", "part").orderBy(*order))).where(f"r <= {int(k)}")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(f"rank <= {int(k)}")
    names = entries.select("query", "item_id").distinct()
    return ranked.join(names, "query").select("item_id", "rank", "doc_id", "score")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best of all documents for each benchmark item."""
    index = build_index(documents(spark, sf_dir), owned_dir(spark, "llm-signatures"))
    return search(index, read_table(spark, sf_dir, "benchmark"))


_EXTRACT = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP13_SQL = f"""
WITH t AS (SELECT doc_id, unnest({_EXTRACT}) AS term FROM documents),
q AS (SELECT DISTINCT item_id, unnest({_EXTRACT}) AS term FROM benchmark),
tf AS (SELECT doc_id, term, CAST(count(*) AS BIGINT) AS tf FROM t GROUP BY ALL),
n AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY ALL),
c AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM n),
w AS (SELECT term, CAST(floor(1000 * ln((2 * CAST(n_docs AS DOUBLE) + 2) / (2 * CAST(count(*) AS DOUBLE) + 1))) AS BIGINT) AS w
      FROM tf CROSS JOIN c GROUP BY term, n_docs),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN tf USING (term) JOIN n USING (doc_id) CROSS JOIN c GROUP BY item_id, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 50
"""
