"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

from __future__ import annotations

import hashlib
import random
import time
import zlib
from datetime import datetime

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from tests.llm import brute
from wardflow.llm import bpe, chat, exact, near, packing, quality, repair, resample, substring, urls
from wardflow.llm.common import Scratch
from wardflow.llm.fm_index import FMIndex
from wardflow.llm.graph import merge_components
from wardflow.llm.tokens import PieceEncoder

VOCAB = public_tokenizers.path("byte_bpe_50k.json")
MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
ROWS = [(1, None), (2, ""), (3, "  \n"), (4, "one two"), (4, "one two"), (5, "one  two"), (None, "null id"),
        (6, LONG), (7, "x" * 50_000), (8, "日本 é <|endoftext|> \x85 end ")]
# columns that clash with names used inside the operators
EXTRA = "doc_id BIGINT, text STRING, node BIGINT, key STRING, row INT, s INT, n INT, label STRING, h INT"


@pytest.fixture
def odd(frame):
    return frame([(d, t, 0, "k", 1, 2, 3, "l", 4) for d, t in ROWS], EXTRA)


@pytest.fixture
def none(frame):
    return frame([], EXTRA)


def test_grammar_file(spark, odd, none, tmp_path):
    repair.write_grammar(odd, f"{tmp_path}/a", VOCAB, end_id=2, block_ids=1000)
    got = repair.read_grammar(spark, f"{tmp_path}/a").orderBy("start").collect()
    enc = PieceEncoder(VOCAB)
    assert [r.doc_id for r in got] == [None, 1, 2, 3, 4, 4, 5, 6, 7, 8]
    texts = {d: t for d, t in ROWS}
    at = 0
    for r in got:
        want = enc.tok.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [2]
        assert np.frombuffer(r.ids, "<u4").tolist() == want and r.start == at
        at += len(want)
    everything = np.concatenate([np.frombuffer(r.ids, "<u4") for r in got])
    for a, b in ((0, 5), (3, 4000), (4100, 4101), (9, 9), (0, at)):
        assert repair.read_range(spark, f"{tmp_path}/a", a, b).tolist() == everything[a:b].tolist()
    repair.write_grammar(none, f"{tmp_path}/b", VOCAB, end_id=2)
    assert repair.read_grammar(spark, f"{tmp_path}/b").count() == 0


@pytest.mark.parametrize("ids", [[], [7], [5] * 1001, [1, 2] * 500 + [2, 1] * 333, list(range(300)) * 9])
def test_repair_round_trip(ids):
    ids = np.array(ids, "<u4")
    t, rules, seq = repair.compress(ids, min_count=4)
    block = repair.Block(t.tobytes(), rules.tobytes(), repair.expansion_lengths(len(t), rules).tobytes(), seq.tobytes())
    assert block.decode().tolist() == ids.tolist()
    assert len(ids) < 1000 or len(seq) + 2 * len(rules) < len(ids) / 2
    for a in range(0, len(ids), 97):
        assert block.decode(a, min(a + 50, len(ids))).tolist() == ids[a:a + 50].tolist()


def test_encoder_equals_library():
    rng = random.Random(5)
    bits = [" ", "  ", "\n", "\n\n", "\t", "\r\n", "a", "the", "Ünder", "123", "0", "'s", "'", "!!", ".", ",", "(", "é", "ÿ", "×", "÷", "À",
            "Ā", "e\u0301", "日本", "　", "\x85", "\x1c", "\0", "***", "\xa0", "ſ", "²", "\U0001f600"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(40))) for _ in range(3000)] + [None, LONG, "", "x" * 3000]
    texts += [a + b + c for a in bits for b in bits for c in ("", " ", "a", "\n")]
    for small in (PieceEncoder(VOCAB, max_pieces=50, max_ids=300), PieceEncoder(VOCAB, max_pieces=500)):
        for k in range(0, len(texts), 500):  # many batches: entries are forgotten and learned again
            part = pa.array(["before"] + texts[k:k + 500]).slice(1)
            ids, at = small.encode(part)
            for i, t in enumerate(part.to_pylist()):
                assert ids[at[i]:at[i + 1]].tolist() == small.tok.encode(t or "", add_special_tokens=False).ids, repr(t)
    assert small.encode(pa.array([], pa.string()))[1].tolist() == [0]


def test_packing(odd, none):
    got = packing.pack_documents(odd, VOCAB).toPandas()
    assert len(got[got.doc_id == 4]) == 2 and got.doc_id.isna().sum() == 1
    assert got.groupby("sequence_id").length.sum().max() <= 2048
    assert (got[got.doc_id == 6].sort_values("piece").length.iloc[1:] == 2048).all()
    assert packing.pack_documents(none, VOCAB).count() == 0


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_packing_under_every_capacity(score):
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 900, 3000)
    cap = packing.Capacity(tokens=1000, documents=3, attention=600_000)
    bins, offsets = packing.best_fit(lengths, cap, score)
    for b in range(bins.max() + 1):
        own = lengths[bins == b]
        assert own.sum() <= 1000 and len(own) <= 3
        assert (own ** 2).sum() <= 600_000 or len(own) == 1
        order = np.argsort(offsets[bins == b])
        assert offsets[bins == b][order].tolist() == [0, *np.cumsum(own[order])[:-1]]


def test_exact(odd, none):
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact.exact_duplicates(odd).collect()]
    assert sorted((g for g in got if g[0] in (1, 2, 3)), key=str) == [(1, 3, 3, False), (2, 3, 3, False), (3, 3, 3, True)]
    assert got.count((4, 5, 3, False)) == 2 and (5, 5, 3, True) in got and (None, None, 1, True) in got
    assert exact.exact_duplicates(none).count() == 0
    kept = exact.keep_owners(odd)
    assert kept.columns == odd.columns and kept.count() == 6


@pytest.mark.parametrize("budget", [0, 400, 1000, 4000, 1 << 40])
def test_trie_spills_by_subtree(budget):
    """Any budget, texts above it, long common prefixes, prefixes of each other, keys off the first branching."""
    rng = np.random.default_rng(1)
    keys = [bytes(rng.integers(97, 100, rng.integers(0, 12)).astype(np.uint8)) for _ in range(600)]
    keys += [b"", b"shared " * 700, b"shared " * 700 + b"x", b"shared " * 700 + b"y" * 3000, b"shared " * 350, b"zz" + bytes(5008)] * 3
    rng.shuffle(keys)
    trie, want = exact.SpillingTrie(budget), {}
    for i, k in enumerate(keys):
        owner = (-len(k) - i % 3, i, 1, hash(k))
        trie.insert(k, owner)
        want[k] = owner if k not in want else (*min(want[k][:2], owner[:2]), want[k][2] + 1, owner[3])
    got = list(trie.items())
    assert len(got) == len(want) and dict(got) == want
    assert (trie.folder is None) == (budget == 1 << 40)


def test_trie_with_one_text_over_the_budget():
    trie = exact.SpillingTrie(1000)
    for i in range(50):
        trie.insert(b"a" * 5008, (0, i, 1, 7))
    assert trie.folder is None and list(trie.items()) == [(b"a" * 5008, (0, 0, 50, 7))]


def test_text_over_the_budget_in_the_operator(spark, frame):
    long = "long text " * 3000
    docs = [(1, long), (2, long + "!"), (3, long.replace(" ", "\n")), (4, "short"), (5, None), (6, long)]
    got = {(r.text_sha256, r.keep_id, r.group_size) for r in exact.text_classes(frame(docs), budget=2000).collect()}
    want = {(hashlib.sha256("".join((t or "").split()).encode()).hexdigest(), *brute.exact(docs)[d]) for d, t in docs}
    assert got == want


def test_substring(odd, none, frame):
    got = substring.remove_repeats(odd).collect()
    assert len(got) == len(ROWS) and all(r.n_removed == 0 for r in got)
    assert substring.remove_repeats(none).count() == 0
    rng = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(55))
    docs = [(d, " ".join(f"r{rng.randrange(1000)}" for _ in range(rng.randrange(40))) + " " + passage + f" tail{d} a b")
            for d in range(60)] + [(100, "x " * 90), (101, None), (102, passage), (103, passage)]
    want = brute.substring(docs, 20)
    for r in substring.remove_repeats(frame(docs)).collect():
        assert (r.n_words, r.n_removed, r.kept_text) == (*want[r.row.doc_id][:2], want[r.row.doc_id][3])


def test_substring_deals_frequent_anchors_by_window(frame, monkeypatch):
    monkeypatch.setattr(substring, "HOT_ROWS", 5)
    passage = " ".join(f"p{i}" for i in range(30))
    docs = [(d, f"a{d} b{d} c{d} {passage} d{d} e{d}") for d in range(40)]
    want = brute.substring(docs, 20)
    got = substring.remove_repeats(frame(docs)).collect()
    assert {r.row.doc_id: r.n_removed for r in got} == {d: x[1] for d, x in want.items()}


def test_substring_leaves_only_the_repeats_on_disk(spark, frame):
    """What the steps shuffled, and the words of segments, are gone before the texts are shuffled for the result."""
    from glob import glob
    from wardflow.session import _OWNED
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        names = [f.getName() for f in spark._jvm.java.util.ArrayList(
            spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(manager.getAllFiles()))]
        return {n for n in names if n.startswith("shuffle_")}
    docs = [(d, f"a{d} b{d} c{d} " + " ".join(f"p{i}" for i in range(30)) + f" d{d}") for d in range(40)]
    rows = frame(docs)
    before, cleanup = shuffled(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    out = substring.remove_repeats(rows)
    until = time.time() + 10
    while shuffled() - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffled() - before
    base = _OWNED[-1].removeprefix("file:")
    assert [p.removeprefix(base) for p in glob(f"{base}/*")] == ["/repeats"]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == cleanup
    want = brute.substring(docs, 20)
    for _ in range(2):  # the result can be read again
        assert {r.row.doc_id: r.n_removed for r in out.collect()} == {d: x[1] for d, x in want.items()}


def test_substring_chunk_of_one_segment():
    words = b" ".join(b"w%d" % (i % 4) for i in range(24))
    assert substring.judge_chunk([(1, 5, 0, 2, 5, words)], 20) == [(5, 0, 6, 1)]


def test_fm_index_counts_and_first_positions():
    rng = np.random.default_rng(4)
    text = np.r_[rng.integers(1, 4, 500), 0]
    index = FMIndex(text, 4, 6)
    at = np.arange(495)
    matched, full, lo, hi = index.matching_windows(text, at, 6)
    first = dict(zip(full.tolist(), zip((hi - lo).tolist(), index.first_positions(lo, hi).tolist())))
    for i in at:
        where = [j for j in at if (text[j:j + 6] == text[i:i + 6]).all()]
        assert (len(where) > 1) == (matched[i] == 6)
        assert i not in first or first[i] == (len(where), where[0])


def test_near(odd, none, frame):
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near.near_duplicates(odd, width=2).collect()}
    assert {(1, 0, 1, True), (2, 0, 2, True), (4, 1, 4, True), (5, 1, 4, False), (7, 1, 7, True)} <= got
    assert any(g[0] is None and g[2] is None and g[3] for g in got)
    assert near.near_duplicates(none).count() == 0


def test_near_group_of_many_variants(frame):
    """One family of near copies, exact copies of one of them, and unlike texts."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for d in range(150):
        w = list(base)
        for _ in range(rng.randrange(9)):
            w[rng.randrange(120)] = f"v{d}x{rng.randrange(1000)}"
        docs.append((d, " ".join(w)))
    docs += [(200 + d, docs[3][1]) for d in range(40)]
    docs += [(300 + d, " ".join(f"u{rng.randrange(10**6)}" for _ in range(50))) for d in range(20)]
    want = brute.near(docs, 2, 80)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near.near_duplicates(frame(docs), width=2).collect()}
    assert got == want


def test_components(spark, frame):
    links = [(i, i + 1) for i in range(30)] + [(100, 50), (50, 70), (7, 90)]
    nodes = sorted({x for p in links for x in p} | {555})
    labels = frame([(n, n) for n in nodes], "node BIGINT, label BIGINT")
    got = merge_components(labels, frame(links, "x BIGINT, y BIGINT"), Scratch(spark, "test"), "m").collect()
    assert {r.node: r.label for r in got} == {n: 50 if n in (50, 70, 100) else 555 if n == 555 else 0 for n in nodes}


def test_quality(odd, none):
    got = quality.apply_rules(odd).collect()
    assert len(got) == len(ROWS) and quality.apply_rules(none).count() == 0
    assert {r.doc_id: r.n_words for r in got} == {d: len(brute.words(t)) for d, t in ROWS}
    assert quality.passing(odd).columns == odd.columns
    rng = random.Random(3)
    for _ in range(200):
        text = " ".join(rng.choice("abc") for _ in range(rng.randrange(60)))
        assert quality.repeat_words(brute.words(text)) == brute.repeats(text)


def test_quality_bands():
    judge = quality._judge(quality.Bands())
    rng = random.Random(8)
    noise = " ".join("".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(12)) for _ in range(400))
    prose = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(600))
    template = " ".join(f"item number {i} costs {i}1 euro" for i in range(100, 500))
    assert judge(0, prose)[-1] and not judge(0, noise)[-1] and not judge(0, template)[-1]
    assert not judge(0, template)[6]


def test_url_lists(frame):
    t = datetime
    pages = frame([(1, "http://a.x.com/1", t(2024, 1, 5)), (1, "http://a.x.com/1", t(2024, 1, 5)),
                   (2, "http://A.x.com:80/2", t(2024, 2, 1)), (3, "https://u@x.com?q", t(2024, 3, 1)),
                   (4, "not a url", t(2024, 3, 1)), (5, None, None), (6, "http://ax.com/", t(2024, 1, 5)),
                   (7, "http://x.com/", None)], "page_id BIGINT, url STRING, fetch_time TIMESTAMP_NTZ")
    lists = frame([("l", "x.com", "add", t(2024, 1, 1)), ("l", "x.com", "add", t(2024, 1, 3)),
                   ("l", "x.com", "remove", t(2024, 2, 1)), ("l", "x.com", "add", t(2024, 3, 1)),
                   ("l", "x.com", "remove", t(2024, 3, 1)), ("k", "a.x.com", "add", t(2024, 1, 31)),
                   ("k", None, "add", t(2024, 1, 1)), ("k", "x.com", "add", None), ("k", "x.com", "remove", t(2023, 1, 1))],
                  "list STRING, key STRING, action STRING, at TIMESTAMP_NTZ")
    got = sorted((r.page_id, r.blocked, r.list, r.key) for r in urls.judge_captures(pages, lists).collect())
    assert got == [(1, True, "l", "x.com"), (1, True, "l", "x.com"), (2, True, "k", "a.x.com"), (3, True, "l", "x.com"),
                   (4, False, None, None), (5, False, None, None), (6, False, None, None), (7, False, None, None)]
    assert urls.judge_captures(pages.limit(0), lists).count() == 0
    assert urls.judge_captures(pages, lists.limit(0)).where("blocked").count() == 0


def test_bpe(odd, none):
    import base64

    import tiktoken
    with open(MULTI, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    both = bpe.decode_ids(bpe.encode_texts(odd, MULTI, public_tokenizers.PATTERN), MULTI, public_tokenizers.PATTERN)
    texts = dict(ROWS)
    got = both.collect()
    assert len(got) == len(ROWS)
    for r in got:
        text = texts[r.doc_id] or ""
        assert np.frombuffer(r.ids, "<u4").tolist() == enc.encode_ordinary(text) and r.decoded.decode() == text
    assert bpe.encode_texts(none, MULTI, public_tokenizers.PATTERN).count() == 0


def test_chat(frame):
    turns = [(1, 0, "user", "a<|end|>\n\\", 9), (1, 1, "user", "", 9), (1, 1, "assistant", "<", 9),
             (1, 2, "assistant", "x\\<|", 9), (1, 3, None, None, 9), (None, None, "assistant", "q", 9),
             (2, 0, "assistant", "é日", 9), (2, 0, "assistant", "é日", 9), (3, 0, "<|x", "|>", 9)]
    schema = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, turns INT"
    back = {r.conv_id: r for r in chat.read_turns(chat.format_conversations(frame(turns, schema))).collect()}
    for conv in (1, 2, 3, None):
        own = sorted(((t or 0, r or "", x or "") for c, t, r, x, _ in turns if c == conv))
        assert [(t.role, t.text) for t in back[conv].turns] == [(r, x) for _, r, x in own]
        assert back[conv].loss_text == "".join(x for _, r, x in own if r == "assistant")
    assert back[2].formatted == "<|start|>assistant<|text|>é日<|next|>é日<|end|>\n"
    assert chat.format_conversations(frame([], schema)).count() == 0


def test_long_conversations(spark):
    """Offsets and masked texts of 40,000 turns in linear time, and a text of two million characters."""
    turns = spark.range(40_000).selectExpr("1L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role",
                                           "concat('é\U0001f600 text <| ', id) AS text")
    one = spark.createDataFrame([(2, 0, "assistant", "x\U0001f600" * 1_000_000), (2, 1, "assistant", "y")],
                                "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    start = time.monotonic()
    back = {r.conv_id: r for r in chat.read_turns(chat.format_conversations(turns.union(one))).collect()}
    assert time.monotonic() - start < 60
    texts = [f"é\U0001f600 text <| {i}" for i in range(40_000)]
    assert [t.text for t in back[1].turns] == texts and back[1].loss_text == "".join(texts[1::2])
    assert [(m.start, m.length) for m in back[1].loss_mask[:2]] == [
        (len("<|start|>user<|text|>é\U0001f600 text <\\| 0<|end|>\n<|start|>assistant<|text|>"), len("é\U0001f600 text <\\| 1")),
        (back[1].formatted.index("text <\\| 3") - 3, len("é\U0001f600 text <\\| 3"))]
    assert back[2].loss_text == "x\U0001f600" * 1_000_000 + "y"


def test_resample(odd, none, frame):
    labels = frame([(6, 1), (6, 1), (4, 0), (None, 1), (7, None)], "doc_id BIGINT, quality INT")
    got = resample.resample(odd, labels, share=0.5).collect()
    assert len(got) == len(ROWS) and 5 <= sum(r.kept for r in got) <= 6
    assert resample.resample(none, labels, share=0.5).count() == 0


def test_kth_largest(spark):
    scored = spark.range(50_000).selectExpr("cast(id % 97 AS double) AS key", "id AS doc_id")
    rows = sorted(((-float(i % 97), i) for i in range(50_000)))
    for k in (1, 600, 25_000, 50_000):
        key, doc = resample.kth_largest(scored, k)
        assert (-key, doc) == rows[k - 1]
    assert resample.kth_largest(scored, 0) is None


def test_crc_is_of_the_ids():
    assert zlib.crc32(np.array([1], "<u4").tobytes()) == zlib.crc32(b"\x01\0\0\0")


def test_windows_of_many_texts_at_once():
    """Segments of a group of texts are those of each text, and their anchors are the first smallest word-grams."""
    from wardflow.llm.substring import GRAM, _gram_hashes, segments_of
    from wardflow.llm.common import word_hashes
    rnd = random.Random(3)
    texts = [[rnd.choice([b"a", b"b", b"c d"[:1], b"long"]) for _ in range(n)] for n in (0, 19, 20, 21, 300, 5, 64, 0, 20)]
    got = list(zip(*(x.tolist() for x in segments_of(texts, 20))))
    want = []
    for i, words in enumerate(texts):
        g = _gram_hashes(word_hashes(words), GRAM).tolist() if len(words) >= 20 else []
        at = [min(range(s, s + 20 - GRAM + 1), key=lambda j: (g[j], j)) for s in range(len(words) - 19)]
        firsts = [s for s in range(len(at)) if not s or at[s] != at[s - 1]]
        for s, e in zip(firsts, [*firsts[1:], len(at)]):
            want.append((np.uint64(g[at[s]]).astype(np.int64).item(), i, s, e - s))
    assert got == want
    assert all(len(x) == 0 for x in segments_of([], 20)) and all(len(x) == 0 for x in segments_of([[], [b"a"] * 19], 20))


def test_suffixes_are_sorted_in_few_passes(monkeypatch):
    from wardflow.llm.fm_index import suffix_array
    rng = np.random.default_rng(1)
    argsort, calls = np.argsort, []
    monkeypatch.setattr(np, "argsort", lambda *a, **k: calls.append(1) or argsort(*a, **k))
    for n, sigma, length in ((0, 3, 20), (1, 3, 20), (2, 3, 1), (500, 3, 20), (400, 2, 5), (3000, 2000, 20), (50, 2, 64)):
        text = rng.integers(0, sigma, n)
        text[n // 2:] = text[:n - n // 2]
        calls.clear()
        order = suffix_array(text, length).tolist()
        assert sorted(order) == list(range(n)) and len(calls) <= 3
        first = [text[i:i + length].tolist() for i in order]
        assert first == sorted(first)
