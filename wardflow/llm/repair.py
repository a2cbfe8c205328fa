"""Re-Pair grammar blocks of token ids (operator 1).

A block holds the ids of consecutive documents.  Compression repeatedly
replaces frequent adjacent pairs by nonterminals; the block keeps the rules and
the expansion length of every symbol, so any id range can be decoded without
expanding the rest.
"""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from wardflow.llm.common import documents, shuffle_partitions, slices
from wardflow.llm.tokens import ID, encoder
from wardflow.session import owned_dir

NULL_ID = -(1 << 63)  # stands for a null doc_id in a block's list
_BLOCK_SCHEMA = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()),
                           *[(c, pa.binary()) for c in ("doc_ids", "doc_lengths", "terminals", "rules", "lengths",
                                                        "sequence")]])
MAX_SYMBOLS = 1 << 16  # symbols fit 16 bits, a pair fits 32
_SPREAD = np.uint32(2654435761)  # odd: the upper bits of its product with a pair depend on the whole pair


def _pick(codes: np.ndarray, min_count: int, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent pairs that cannot overlap each other, most frequent first, and all frequent pairs.

    A symbol is used only on the left or only on the right side of this
    round's pairs, so no two chosen occurrences share a position.
    """
    ordered = np.sort(codes)
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    count = np.diff(np.r_[first, len(ordered)])
    often = np.flatnonzero(count >= min_count)
    pairs = ordered[first[often]]
    pairs = pairs[np.argsort(-count[often], kind="stable")]
    side: dict[int, int] = {}
    chosen = []
    for code, a, b in zip(pairs.tolist(), (pairs >> 16).tolist(), (pairs & 0xFFFF).tolist()):
        if len(chosen) == room:
            break
        if a == b:
            if a in side:
                continue
            side[a] = 3
        else:
            if side.get(a, 1) != 1 or side.get(b, 2) != 2:
                continue
            side[a], side[b] = 1, 2
        chosen.append(code)
    return np.array(chosen, np.uint32), pairs


def _slots(codes: np.ndarray) -> np.ndarray:
    """A 16-bit number for each pair; different pairs may share one."""
    return codes * _SPREAD >> np.uint32(16)


def _find(codes: np.ndarray, chosen: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which codes may be frequent pairs (all of ``often`` and few others, equal codes alike), where ``chosen``
    pairs are among the codes, and which ones."""
    table = np.full(MAX_SYMBOLS, -2, np.int32)
    table[_slots(often)] = -1
    table[_slots(chosen)] = np.arange(len(chosen))
    slot = table[_slots(codes)]
    hit = np.flatnonzero(slot >= 0)
    k, found = slot[hit], codes[hit]
    other = np.flatnonzero(chosen[k] != found)  # no chosen pair, or one that shares its slot
    order = np.argsort(chosen)
    k[other] = order[np.searchsorted(chosen, found[other], sorter=order).clip(max=len(chosen) - 1)]
    other = other[chosen[k[other]] != found[other]]
    return slot > -2, np.delete(hit, other), np.delete(k, other)


def compress(ids: np.ndarray, min_count: int = 16):
    """Grammar of ``ids``: (terminals, rules[k, 2], sequence).

    Symbols below ``len(terminals)`` are ids, the others rules in order.  Rounds
    go on until no pair occurs ``min_count`` times or symbols run out.  A block of 65,536 different ids or
    more (a larger vocabulary than the one used here) has no symbols for rules and stays as it is.

    A round looks only at places whose pair may be frequent.  Pairs of old symbols only get rarer, so a pair
    once below ``min_count`` stays there; new pairs stand beside the round's new symbols.  The count of a
    frequent pair is thus of all its places.
    """
    present = np.zeros(int(ids.max(initial=0)) + 1, bool)
    ids = ids.astype(np.intp)
    present[ids] = True
    terminals = np.flatnonzero(present) if len(ids) else np.zeros(0, ID)
    seq = (np.cumsum(present, dtype=np.uint32) - np.uint32(1))[ids]
    if len(terminals) >= MAX_SYMBOLS:
        return terminals.astype(ID), np.zeros((0, 2), ID), seq.astype(ID)
    rules: list[np.ndarray] = []
    n, size = len(terminals), len(seq)
    # symbols stay at their places; the neighbours that are left are linked, ``size`` stands for none
    after, before = np.arange(1, size + 2), np.arange(-1, size)
    left, look = np.ones(size, bool), np.empty(size + 1, bool)
    here = np.arange(max(size - 1, 0))
    codes = (seq[:-1] << np.uint32(16)) | seq[1:]
    while n < MAX_SYMBOLS:
        chosen, often = _pick(codes, min_count, MAX_SYMBOLS - n)
        if not len(chosen):
            break
        may, hit, k = _find(codes, chosen, often)
        at = here[hit]
        twin = np.flatnonzero((chosen >> 16 == chosen & 0xFFFF)[k])
        if len(twin):  # runs of one symbol: pairs from the start of each run, which are hits one after another
            p = at[twin]
            first = np.r_[True, p[1:] != after[p[:-1]]]
            nth = np.arange(len(p))
            ok = np.ones(len(at), bool)
            ok[twin] = (nth - np.maximum.accumulate(np.where(first, nth, 0))) % 2 == 0
            at, k = at[ok], k[ok]
        gone = after[at]
        seq[at] = n + k
        after[at] = after[gone]
        before[after[at]] = at
        left[gone] = False
        rules.append(np.stack([chosen >> 16, chosen & 0xFFFF], 1))
        n += len(chosen)
        look[:] = False
        look[here] = may
        look[at] = True
        look[before[at]] = True  # of the first place: the last entry, which is no place
        look[gone] = False
        here = np.flatnonzero(look[:size])
        if len(here) and after[here[-1]] == size:
            here = here[:-1]
        codes = (seq[here] << np.uint32(16)) | seq[after[here]]
    table = np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)
    return terminals.astype(ID), table.astype(ID), seq[left].astype(ID)


def expansion_lengths(n_terminals: int, rules: np.ndarray) -> np.ndarray:
    """Ids that each symbol expands to."""
    out = [1] * n_terminals
    for a, b in rules.tolist():
        out.append(out[a] + out[b])
    return np.array(out, ID)


class Block:
    """A grammar block opened for decoding."""

    def __init__(self, terminals: bytes, rules: bytes, lengths: bytes, seq: bytes):
        self.terminals = np.frombuffer(terminals, ID)
        self.rules = np.frombuffer(rules, ID).reshape(-1, 2)
        self.lengths = np.frombuffer(lengths, ID).astype(np.int64)
        self.seq = np.frombuffer(seq, ID)
        self.ends = np.cumsum(self.lengths[self.seq])

    def __len__(self) -> int:
        return int(self.ends[-1]) if len(self.ends) else 0

    def _whole(self) -> np.ndarray:
        """All ids: the expansions of all symbols go into one array, rule by rule, and are copied from there."""
        parts = [t.to_bytes(ID.itemsize, "little") for t in self.terminals.tolist()]
        for a, b in self.rules.tolist():
            parts.append(parts[a] + parts[b])
        flat = np.frombuffer(b"".join(parts), ID)
        n = self.lengths[self.seq]
        first = (np.cumsum(self.lengths) - self.lengths)[self.seq]
        # steps from one id's place to the next one's: 1 within a symbol
        take = np.ones(len(self), np.int64)
        take[self.ends - n] = first - np.r_[0, (first + n - 1)[:-1]]
        return flat[np.cumsum(take, out=take)]

    def decode(self, start: int = 0, end: int | None = None) -> np.ndarray:
        """Ids [start, end) of the block; of the rules only what covers them is expanded."""
        end = len(self) if end is None else end
        if end <= start:
            return np.zeros(0, ID)
        if (start, end) == (0, len(self)):
            return self._whole()
        i, j = np.searchsorted(self.ends, [start, end - 1], side="right")
        part = self.seq[i:j + 1]
        skip, n, n_terminals = start - (self.ends[i] - self.lengths[part[0]]), end - start, len(self.terminals)
        # one level of the rules at a time; what lies before or after the range is dropped unexpanded
        while (nested := part >= n_terminals).any():
            at = np.arange(len(part)) + np.cumsum(nested) - nested
            below = np.empty(len(part) + np.count_nonzero(nested), ID)
            below[at[~nested]] = part[~nested]
            pair, at = self.rules[part[nested] - n_terminals], at[nested]
            below[at], below[at + 1] = pair[:, 0], pair[:, 1]
            size = self.lengths[below]
            ends = np.cumsum(size)
            i, j = np.searchsorted(ends, [skip, skip + n - 1], side="right")
            part, skip = below[i:j + 1], skip - (ends[i] - size[i])
        return self.terminals[part]


# ---- Spark operator -------------------------------------------------------

BLOCK_DDL = ("part INT, block INT, start BIGINT, n_ids BIGINT, doc_ids BINARY, doc_lengths BINARY, "
             "terminals BINARY, rules BINARY, lengths BINARY, sequence BINARY")


def _encode_task(vocab: str, end_id: int, block_ids: int):
    def run(batches):
        task = TaskContext.get()
        part = task.partitionId() if task else 0
        held: list[np.ndarray] = []
        docs: list[tuple[int, int]] = []
        state = {"block": 0, "start": 0, "n": 0}

        def flush():
            ids = np.concatenate(held)
            terminals, rules, seq = compress(ids)
            row = {"part": part, "block": state["block"], "start": state["start"], "n_ids": len(ids),
                   "doc_ids": np.array([d for d, _ in docs], "<i8").tobytes(),
                   "doc_lengths": np.array([n for _, n in docs], "<i8").tobytes(),
                   "terminals": terminals.tobytes(), "rules": rules.tobytes(),
                   "lengths": expansion_lengths(len(terminals), rules).tobytes(), "sequence": seq.tobytes()}
            state["block"] += 1
            state["start"] += len(ids)
            state["n"] = 0
            held.clear()
            docs.clear()
            return pa.RecordBatch.from_pylist([row], schema=_BLOCK_SCHEMA)

        enc = encoder(vocab)
        for rows in slices(batches):
            ids, at = enc.encode(rows.column(1))
            for i, doc in enumerate(rows.column(0).to_pylist()):
                one = np.append(ids[at[i]:at[i + 1]], ID.type(end_id))
                held.append(one)
                docs.append((NULL_ID if doc is None else doc, len(one)))
                state["n"] += len(one)
                if state["n"] >= block_ids:
                    yield flush()
        if docs:
            yield flush()
    return run


def write_grammar(docs: DataFrame, path: str, vocab: str, end_id: int, block_ids: int = 1 << 18) -> None:
    """Encode ``docs`` (doc_id, text) and write grammar blocks in ascending doc_id order.

    Rows are dealt by ranges of (doc_id, text hash), so a task holds one range,
    and a task writes blocks of about ``block_ids`` ids of whole documents.  A
    null text has only the end id; a null doc_id comes first; repeated rows are
    kept, equal doc_ids in the order of their text hash.
    """
    spark = docs.sparkSession
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    (keyed.repartitionByRange(shuffle_partitions(spark), "doc_id", "h")
     .sortWithinPartitions("doc_id", "h")
     .select("doc_id", "text")
     .mapInArrow(_encode_task(vocab, end_id, block_ids), BLOCK_DDL)
     .write.parquet(path))


def open_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of a grammar file; ``start`` counts ids from the file's beginning."""
    blocks = spark.read.schema(BLOCK_DDL).parquet(path)
    # one row for each writing task: bounded by the number of range partitions
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    return (blocks.join(F.broadcast(before), "part")
            .withColumn("start", F.col("start") + F.col("base")).drop("base"))


def _decode_batch(rows: pa.RecordBatch, summarise) -> dict[str, list]:
    out: dict[str, list] = {"doc_id": [], "start": [], "ids": []}
    for r in rows.to_pylist():
        ids = Block(r["terminals"], r["rules"], r["lengths"], r["sequence"]).decode()
        n = np.frombuffer(r["doc_lengths"], "<i8")
        ends = np.cumsum(n)
        for doc, a, b in zip(np.frombuffer(r["doc_ids"], "<i8").tolist(), (ends - n).tolist(), ends.tolist()):
            out["doc_id"].append(None if doc == NULL_ID else doc)
            out["start"].append(r["start"] + a)
            out["ids"].append(summarise(ids[a:b]))
    return out


def read_grammar(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a grammar file: doc_id, start, ids (little-endian unsigned 32-bit)."""
    def run(batches):
        for rows in slices(batches, 1):
            d = _decode_batch(rows, lambda x: x.tobytes())
            yield pa.RecordBatch.from_pydict(d, pa.schema([("doc_id", pa.int64()), ("start", pa.int64()),
                                                           ("ids", pa.binary())]))
    return open_blocks(spark, path).mapInArrow(run, "doc_id BIGINT, start BIGINT, ids BINARY")


def read_range(spark: SparkSession, path: str, start: int, end: int) -> np.ndarray:
    """Ids [start, end) of a grammar file; only the blocks that hold them are read and only in part expanded."""
    rows = (open_blocks(spark, path).where((F.col("start") < end) & (F.col("start") + F.col("n_ids") > start))
            .orderBy("start").collect())
    parts = [Block(r.terminals, r.rules, r.lengths, r.sequence).decode(max(0, start - r.start),
                                                                       min(r.n_ids, end - r.start)) for r in rows]
    return np.concatenate(parts) if parts else np.zeros(0, ID)


def op1_grammar_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents as a grammar file and read it back: one row per document.

    ``ids_crc32`` and ``n_tokens`` are taken from the decoded ids.
    """
    path = owned_dir(spark, "llm-grammar")
    write_grammar(documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)

    def run(batches):
        for rows in slices(batches, 1):
            d = _decode_batch(rows, lambda x: (len(x), zlib.crc32(x.tobytes())))
            yield pa.RecordBatch.from_pydict(
                {"doc_id": d["doc_id"], "start": d["start"], "n_tokens": [n for n, _ in d["ids"]],
                 "ids_crc32": [c for _, c in d["ids"]]},
                pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "n_tokens", "ids_crc32")]))
    return open_blocks(spark, path).mapInArrow(run, "doc_id BIGINT, start BIGINT, n_tokens BIGINT, ids_crc32 BIGINT")
